"""Query of the packing."""

from sitrec.llm.packing import pack_documents
from sitrec.llm.registry import documents, query


@query("op2_best_two_fit")
def packed(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir))
