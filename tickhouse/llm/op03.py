"""Query op3: components of documents linked by their word n-grams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import ngram_join
from tickhouse.llm.registry import register, table

SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w
  from documents
), grams as (
  select distinct doc_id, unnest(case when len(w) = 0 then []
    when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as gram
  from words
), sizes as (select doc_id, count(*) as n from grams group by 1),
links as (
  select a.doc_id as x, b.doc_id as y
  from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id
  join sizes s on s.doc_id = a.doc_id join sizes t on t.doc_id = b.doc_id
  group by 1, 2, s.n, t.n having 100 * count(*) >= 85 * (s.n + t.n - count(*))
), reach as (
  select doc_id as x, doc_id as y from documents
  union select r.x, l.y from reach r join links l on l.x = r.y
)
select d.doc_id, coalesce(any_value(s.n), 0) as n_shingles, min(r.y) as component_id
from documents d join reach r on r.x = d.doc_id left join sizes s on s.doc_id = d.doc_id
group by d.doc_id
"""


@register("op3_multi_order_join", SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))
