"""Query of the whitened embeddings."""

from sitrec.llm.registry import query
from sitrec.llm.whitening import by_component, whiten


@query("op11_embedding_whitening")
def whitened(spark, sf_dir):
    return by_component(whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=4))
