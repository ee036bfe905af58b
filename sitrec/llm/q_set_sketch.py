"""Query of the near-duplicates by sets of shingles."""

from sitrec.llm.registry import documents, query
from sitrec.llm.set_dedup import near_sets


@query("op12_minhash_sets")
def near(spark, sf_dir):
    return near_sets(documents(spark, sf_dir).select("doc_id", "text"))
