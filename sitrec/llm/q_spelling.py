"""Query of the spelling variants."""

from sitrec.llm.registry import documents, query
from sitrec.llm.spelling import spelling_forms


@query("op13_spelling_variants")
def variants(spark, sf_dir):
    return spelling_forms(documents(spark, sf_dir).select("doc_id", "text"))
