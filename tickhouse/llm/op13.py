"""Query op13: all documents in 40 shards by jump consistent hashing of doc_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import sharding
from tickhouse.llm.registry import register, table

SHARDS = 40

SQL = f"""
with recursive walk as (
  select id, (coalesce(id, 0)::hugeint + 18446744073709551616) % 18446744073709551616 as x,
    -1::bigint as stop, 0::bigint as next
  from (select distinct doc_id as id from documents)
  union all
  select id, y, next, cast(floor((next + 1) * (2147483648::double / (y // 8589934592 + 1)::double)) as bigint)
  from (select *, (x * 2862933555777941757 + 1) % 18446744073709551616 as y
    from walk where next < {SHARDS})
), shards as (
  select id, stop as shard, case when next = {SHARDS} then {SHARDS} else stop end as grown_shard
  from walk where next >= {SHARDS}
), crc_table as (
  select list_transform(range(256), lambda i: list_reduce(
    list_prepend(i::bigint, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), rows as (
  select doc_id, 16 + strlen(coalesce(text, '')) as size,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint)),
      lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) as text_crc32
  from documents, crc_table
)
select doc_id, size, text_crc32, '{sharding.LAW}' as law, cast(shard as integer) as shard,
  row_number() over (partition by shard order by doc_id nulls first, text_crc32, size) - 1 as slot,
  cast(grown_shard as integer) as grown_shard
from rows join shards on id is not distinct from doc_id
"""


@register("op13_jump_shards", SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place_documents(table(spark, sf_dir, "documents"), SHARDS)
