"""Query of the quality classifier."""

from sitrec.llm.quality_fm import learn, score_quality
from sitrec.llm.registry import documents, query


@query("op9_quality_fm")
def quality(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model)
