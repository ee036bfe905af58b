"""Query of the language identification."""

from sitrec.llm.language import identify, learn
from sitrec.llm.columns import held_out
from sitrec.llm.registry import documents, query


@query("op5_compression_language")
def language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = learn(docs)
    texts = docs.select("doc_id", "text")  # no label, source or other column reaches a prediction
    out = identify(texts, model)
    return out.select("doc_id", held_out(out.doc_id).alias("held_out"), "lang_pred", "score", "rejected")
