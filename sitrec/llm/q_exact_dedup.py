"""Query of the exact deduplication."""

from sitrec.llm.exact_dedup import exact_dedup
from sitrec.llm.registry import documents, query

SQL = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x
  from documents),
h as (select doc_id, sha256(x) as text_sha256 from t)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, text_sha256
from h window w as (partition by text_sha256)
"""


@query("op7_exact_dedup", SQL)
def exact(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
