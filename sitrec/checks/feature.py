"""Indexes, dictionaries, vectors, text features, correlations."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from sitrec.checks.base import fine, query, ratings, row, scaled
from sitrec.functions.scalar import rounded
from sitrec.operators import encoding, text, vectors
from sitrec.operators.joins import lookup_join
from sitrec.sources import features
from sitrec.sources.tables import table

CONTEXTS = ("Time", "Location", "Companion")


@query("string_index", """select itemid, idx as "itemidI", n from iidx""", "iidx")
def string_index(spark, sf_dir):
    return encoding.index_table(fine(spark, sf_dir), "itemid").select("itemid", F.col("idx").alias("itemidI"), "n")


@query(
    "assemble_indexed",
    """, u as (select userid, row_number() over (order by count(*) desc, userid) - 1 as i from rat group by userid),
    m as (select itemid, row_number() over (order by count(*) desc, itemid) - 1 as i from rat group by itemid)
    select row_id, rating as label, u.i || ' ' || m.i || ' ' || t.idx || ' ' || l.idx || ' ' || c.idx as features
    from rat join u using (userid) join m using (itemid)
    join ctxidx t on t.d = 'Time' and t.val = "Time" join ctxidx l on l.d = 'Location' and l.val = "Location"
    join ctxidx c on c.d = 'Companion' and c.val = "Companion" """,
    "rat ctxidx",
)
def assemble_indexed(spark, sf_dir):
    df = _indexed(ratings(spark, sf_dir), encoding.ENCODED)
    rows = encoding.assemble(df, [f"{c}I" for c in encoding.ENCODED])
    values = F.transform(vector_to_array("features"), lambda x: x.cast("bigint").cast("string"))
    return rows.select("row_id", F.col("rating").alias("label"), F.array_join(values, " ").alias("features"))


def _indexed(df, columns):
    base = df
    for c in columns:
        df = encoding.string_index(df, c, f"{c}I", encoding.index_table(base, c), row())
    return df


@query("feature_dictionary", "select block, val, n, idx from dic", "dic")
def feature_dictionary(spark, sf_dir):
    return encoding.feature_dictionary(ratings(spark, sf_dir)).select("block", "val", "n", "idx")


@query("encode_features_long", "select row_id, idx, 1.0::double as val from feat", "feat")
def encode_features_long(spark, sf_dir):
    df = ratings(spark, sf_dir)
    rows = encoding.encode(df, encoding.feature_dictionary(df), row())
    return features.long_features(rows, "row_id")


@query("encode_vectors", "select row_id, idx, 1.0::double as val from feat", "feat")
def encode_vectors(spark, sf_dir):
    """The same features as one ML vector: block indexes, one-hot, assembled."""
    df = base = ratings(spark, sf_dir)
    for c in encoding.ENCODED:
        df = encoding.string_index(df, c, f"{c}I", encoding.index_table(base, c, "alphabetAsc"), row())
    coded = encoding.one_hot_vectors(df, [f"{c}I" for c in encoding.ENCODED]).select("row_id", "features")
    return features.long_features(features.vector_parts(coded), "row_id")


@query(
    "one_hot",
    """select row_id, t::bigint as slot from ctxrow where t < (select max(t) from ctxrow)""",
    "ctxrow",
)
def one_hot(spark, sf_dir):
    df = _indexed(ratings(spark, sf_dir), ["Time"]).select("row_id", "TimeI")
    coded = OneHotEncoder(inputCol="TimeI", outputCol="features").fit(df).transform(df).drop("TimeI")
    return features.long_features(features.vector_parts(coded), "row_id").select("row_id", F.col("idx").alias("slot"))


@query("index_to_string", """select row_id, idx::double as "itemidI", itemid as label from rat5 join iidx using (itemid)""", "rat5 iidx")
def index_to_string(spark, sf_dir):
    df = fine(spark, sf_dir)
    index = encoding.index_table(df, "itemid")
    coded = encoding.string_index(df, "itemid", "itemidI", index, row()).select("row_id", "itemidI")
    return encoding.index_to_string(coded, "itemidI", "label", index, "itemid", row())


# ---- vectors -----------------------------------------------------------------------------------


def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def _vectors(spark, sf_dir):
    return vectors.as_vector(_embeddings(spark, sf_dir), "embedding").drop("embedding")


@query(
    "minmax_scale",
    """, r as (select dim, min(x) as lo, max(x) as hi from emb group by dim)
    select vec_id, dim::int as dim, round(case when hi = lo then 0.5 else (x - lo) / (hi - lo) end, 6) + 0.0 as value
    from emb join r using (dim)""",
    "emb",
)
def minmax_scale(spark, sf_dir):
    df = vectors.min_max_scale(_vectors(spark, sf_dir))
    return vectors.vector_long(df, "vec_id", "scaled", "value").withColumn("value", rounded(F.col("value")))


@query("vector_slice", "select vec_id, (dim - 1)::int as dim, x as value from emb where dim in (1, 2)", "emb")
def vector_slice(spark, sf_dir):
    df = vectors.slice_vector(_vectors(spark, sf_dir), indices=(1, 2))
    return vectors.vector_long(df, "vec_id", "sliced", "value")


@query(
    "dct",
    """, ks as (select unnest(range(64)) as k)
    select vec_id, k::int as dim,
      round(sqrt((case when k = 0 then 1.0 else 2.0 end) / 64) * sum(x * cos(pi() * (dim + 0.5) * k / 64)), 6) + 0.0
        as value
    from emb, ks group by vec_id, k""",
    "emb",
)
def dct(spark, sf_dir):
    df = vectors.cosine_transform(_vectors(spark, sf_dir))
    return vectors.vector_long(df, "vec_id", "dct", "value").withColumn("value", rounded(F.col("value")))


@query(
    "covariance",
    """select a.dim::int as i, b.dim::int as j, round(covar_samp(a.x, b.x), 6) + 0.0 as covariance
    from emb a join emb b on a.vec_id = b.vec_id and a.dim <= b.dim group by a.dim, b.dim""",
    "emb",
)
def covariance(spark, sf_dir):
    df = vectors.covariance(_embeddings(spark, sf_dir), "embedding")
    return df.withColumn("covariance", rounded(F.col("covariance")))


@query("pca")
def pca(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    return vectors.fit_pca(df, 3).transform(df).select("vec_id", vector_to_array("pca").alias("components"))


@query(
    "pearson",
    """select 'Time' as a, 'Location' as b, round(corr(t, l), 6) + 0.0 as r from ctxrow
    union all select 'Companion', 'Time', round(corr(c, t), 6) + 0.0 from ctxrow
    union all select 'Location', 'Companion', round(corr(l, c), 6) + 0.0 from ctxrow""",
    "ctxrow",
)
def pearson(spark, sf_dir):
    df = encoding.assemble(_indexed(ratings(spark, sf_dir), CONTEXTS), [f"{c}I" for c in CONTEXTS])
    matrix = vectors.pearson_matrix(df)
    pairs = (("Time", "Location"), ("Companion", "Time"), ("Location", "Companion"))
    at = {c: i for i, c in enumerate(CONTEXTS)}
    rows = [(a, b, float(matrix[at[a], at[b]])) for a, b in pairs]
    return spark.createDataFrame(rows, "a string, b string, r double").withColumn("r", rounded(F.col("r")))


_RANKS = ", ".join(
    f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {c}" for c in ("x", "y")
)


@query(
    "spearman",
    f""", k as (select {_RANKS} from (select value as x, rating as y from rat))
    select round(corr(x, y), 6) + 0.0 as r from k""",
    "rat",
)
def spearman(spark, sf_dir):
    from sitrec.sources.tables import contextual_ratings

    df = contextual_ratings(spark, sf_dir).select("row_id", "value", "rating")
    for c in ("value", "rating"):
        ranks = vectors.average_ranks(df, c, f"{c}_rank").drop("n")
        df = lookup_join(df, ranks, c, row())
    return df.agg(rounded(F.corr("value_rank", "rating_rank")).alias("r"))


@query(
    "spearman_matrix",
    """, k as (select vec_id, dim, rank() over (partition by dim order by x)
      + (count(*) over (partition by dim, x) - 1) / 2.0 as r from emb)
    select a.dim::int as i, b.dim::int as j, round(corr(a.r, b.r), 6) + 0.0 as correlation
    from k a join k b using (vec_id) where a.dim <= b.dim group by a.dim, b.dim""",
    "emb",
)
def spearman_matrix(spark, sf_dir):
    df = vectors.spearman_matrix(_embeddings(spark, sf_dir), "vec_id", "embedding")
    return df.withColumn("correlation", rounded(F.col("correlation")))


# ---- text --------------------------------------------------------------------------------------


def _words(spark, sf_dir):
    return text.tokenize(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "words")


@query(
    "tokenize",
    r"""select doc_id, (pos - 1)::int as pos, words[pos] as token from (
      select doc_id, words, unnest(range(1, len(words) + 1)) as pos from (
        select doc_id, string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s') as words from documents))""",
)
def tokenize(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", F.posexplode("words").alias("pos", "token"))


@query("term_counts", "select doc_id, term, count(*) as tf from tok group by doc_id, term", "tok")
def term_counts(spark, sf_dir):
    return text.term_counts(_words(spark, sf_dir), "doc_id")


@query(
    "tf_idf",
    """, c as (select doc_id, term, count(*) as tf from tok group by doc_id, term),
    d as (select term, ln(((select count(*) from documents) + 1) / (count(*) + 1)) as idf from c group by term)
    select doc_id, term, tf, round(idf, 6) + 0.0 as idf, round(tf * idf, 6) + 0.0 as tf_idf from c join d using (term)""",
    "tok",
)
def tf_idf(spark, sf_dir):
    df = text.tf_idf(_words(spark, sf_dir), "doc_id")
    return df.withColumns({c: rounded(F.col(c)) for c in ("idf", "tf_idf")})


@query("hashing_tf")
def hashing_tf(spark, sf_dir):
    df = text.hashing_tf(_words(spark, sf_dir), 20).select("doc_id", "features")
    return features.long_features(features.vector_parts(df), "doc_id")


@query("hashing_tf_mass", "select doc_id, count(*)::double as n from tok group by doc_id", "tok")
def hashing_tf_mass(spark, sf_dir):
    """Hashing moves terms to buckets and loses none: the buckets of a text add up to its tokens."""
    df = text.hashing_tf(_words(spark, sf_dir), 20)
    mass = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda total, x: total + x)
    return df.select("doc_id", mass.alias("n"))


@query("word2vec")
def word2vec(spark, sf_dir):
    df = _words(spark, sf_dir)
    model = text.fit_word2vec(df, size=3, min_count=0)
    return model.transform(df).select("doc_id", vector_to_array("vector").alias("vector"))
