"""Query of the source mixing: all sources to equal weights."""

from sitrec.llm.mixing import mix_sources
from sitrec.llm.registry import documents, query

SQL = """
with recursive vol as (select source, sum(length(coalesce(text, '')))::double as v from documents group by source),
tot as (select sum(v) as all_v, count(*)::double as w from vol),
rate as (select source, case when v > 0 then 1.0::double * (1.0::double * all_v / w) / v else 1.0::double end as r
  from vol, tot),
parts as (select source, greatest(ceil(r / 32.0::double), 1)::int as m, r / greatest(ceil(r / 32.0::double), 1) as lam
  from rate),
cdf as (
  select source, m, lam, 0 as k, exp(-lam) as p, exp(-lam) as c from parts
  union all
  select source, m, lam, k + 1, p * lam / (k + 1), c + p * lam / (k + 1) from cdf
  where k < ceil(lam + sqrt(lam) * 12 + 20)),
lists as (select source, m, list(c order by k) as cs from cdf group by source, m),
draws as (
  select d.doc_id, cs, ('0x' || substr(md5('42:' || coalesce(d.doc_id::varchar, '') || ':' || part), 1, 13))::bigint
    / 4503599627370496.0::double as u
  from documents d join lists l on d.source is not distinct from l.source, unnest(range(m)) as x(part)),
n as (select doc_id, sum(len(list_filter(cs, lambda c: c <= u)))::int as n_copies from draws group by doc_id)
select d.doc_id, text, lang, source, n_chars, copy::int as copy, n_copies,
  ('0x' || substr(md5('42:order:' || coalesce(d.doc_id::varchar, '') || ':' || copy), 1, 13))::bigint as shuffle_key
from documents d join n using (doc_id), unnest(range(n_copies)) as y(copy)
"""


@query("op10_mix_sources", SQL)
def mixed(spark, sf_dir):
    return mix_sources(documents(spark, sf_dir))
