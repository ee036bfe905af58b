"""Query of the SimHash near-duplicates."""

from sitrec.llm.registry import documents, query
from sitrec.llm.simhash import near_classes


@query("op6_simhash")
def near(spark, sf_dir):
    return near_classes(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
