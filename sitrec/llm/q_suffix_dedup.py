"""Query of the removal of repeated strings."""

from pyspark.sql import functions as F

from sitrec.llm.registry import documents, query
from sitrec.llm.suffix_dedup import suffix_dedup


@query("op1_suffix_dedup")
def repeats(spark, sf_dir):
    out = suffix_dedup(documents(spark, sf_dir))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return out.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))
