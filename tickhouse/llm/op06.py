"""Query op6: what every document shares with the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import decontaminate
from tickhouse.llm.registry import register, table

WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
SQL = f"""
with docs as (select doc_id, {WORDS} as w from documents),
items as (select item_id, {WORDS} as w from benchmark),
wanted as (
  select distinct item_id, m, array_to_string(w[k:k + m - 1], ' ') as key
  from (select item_id, w, least(13, len(w)) as m,
    unnest(range(1, len(w) - least(13, len(w)) + 2)) as k from items where len(w) > 0)
), spots as (
  select doc_id, k, m, array_to_string(w[k:k + m - 1], ' ') as key
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as k
    from docs, (select distinct m from wanted) where len(w) >= m)
), found as (select doc_id, item_id, k, m from spots join wanted using (key, m)),
hits as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(k, k + m)) as place from found) group by 1
), named as (
  select doc_id, count(*) as n_items, sha256(string_agg(name, ',' order by name)) as items_sha256
  from (select distinct doc_id, item_id::varchar as name from found) group by 1
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256,
  coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from docs left join hits using (doc_id) left join named using (doc_id)
"""


@register("op6_suffix_decontamination", SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )
