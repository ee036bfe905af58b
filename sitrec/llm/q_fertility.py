"""Query of the quality rules."""

from sitrec.llm.fertility import quality_rules
from sitrec.llm.registry import documents, query


@query("op3_fertility_rules")
def rules(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir))
