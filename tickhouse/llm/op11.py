"""Query op11: the ten best documents for each benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import treap
from tickhouse.llm.registry import register, table

TOP = 10

WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)
SQL = f"""
with words as (select row_number() over () as row, doc_id, {WORDS} as w from documents),
totals as (
  select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from words
), postings as (
  select row, any_value(doc_id) as doc_id, term, any_value(n) as n, count(*) as tf
  from (select row, doc_id, len(w) as n, unnest(w) as term from words) group by row, term
), weights as (
  select term, cast(floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double)) as bigint) as weight
  from postings, totals group by term
), asked as (
  select distinct item, item_id, term
  from (select row_number() over () as item, item_id, unnest({WORDS}) as term from benchmark)
), scores as (
  select item, any_value(item_id) as item_id, row, any_value(doc_id) as doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::bigint as score
  from asked join postings using (term) join weights using (term), totals
  group by item, row
), ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls first) as rank
  from scores where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {TOP}
"""


@register("op11_k2_treap_search", SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), TOP)
