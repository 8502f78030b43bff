"""Query op12: damaged conversations, their faults and their cheapest repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import dialogue
from tickhouse.llm.registry import register, table

# What a row's remainder does to it; other remainders leave the row alone.
DROP, EMPTY, UNSTOP, REPEAT, USER = range(5)
KINDS = 20


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage; nulls of role and text are one space."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(key) % KINDS
    text = F.coalesce("text", space)
    copies = F.when(kind == DROP, 0).when(kind == REPEAT, 2).otherwise(1)
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == USER, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == EMPTY, F.lit(""))
        .when(kind == UNSTOP, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def least(*options: str) -> str:
    return "least(" + ", ".join(options) + ")"


def then(letter: str, cost: str, after: str) -> str:
    """A value (9 digits of cost, then edits) with one more edit in front."""
    return f"printf('%09d', {after}[:9]::bigint + {cost}) || '{letter}' || {after}[10:]"


# Of two values the lesser text has the lesser cost or, at equal costs, the edits that ASCII puts first.
SQL = f"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(
    list_prepend(i::bigint, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), kinds as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
        regexp_extract_all(hex(encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))), '..'),
        lambda h: ('0x' || h)::bigint)),
      lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 20 as kind
  from conversations, crc_table
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, copy
  from (select *, unnest(range(case when kind = 0 then 0 when kind = 3 then 2 else 1 end)) as copy from kinds)
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen,
    case when role[:1] in ('s', 'u', 'a') then role[:1] else 'o' end as c
  from damaged
), rows as (
  select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank' when seen > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 'truncated' else '' end as fault,
    lag(c) over (partition by conv_id order by i) || c as pair
  from numbered
), costs as (
  select conv_id, max(i) as i, '000000000' as q0, '000000004II' as qs, '000000002I' as qu, '000000000' as qa
  from rows group by conv_id
  union all
  select conv_id, i - 1,
    {least("x0", then("I", "2", "xu"), then("II", "4", "xa"))}, {least("xs", then("I", "2", "xu"), then("II", "4", "xa"))},
    {least("xu", then("I", "2", "xa"))}, {least("xa", then("I", "2", "xu"))}
  from (
    select conv_id, i,
      case when live then {least(then("D", "3", "q0"), then("R", "2 + cut", "qu"), f"case c when 's' then {then('K', 'cut', 'qs')} when 'u' then {then('K', 'cut', 'qu')} else '9' end")}
        else {then("D", "3", "q0")} end as x0,
      case when live then {least(then("D", "3", "qs"), then("R", "2 + cut", "qu"), f"case c when 'u' then {then('K', 'cut', 'qu')} else '9' end")}
        else {then("D", "3", "qs")} end as xs,
      case when live then {least(then("D", "3", "qu"), then("R", "2 + cut", "qa"), f"case c when 'a' then {then('K', 'cut', 'qa')} else '9' end")}
        else {then("D", "3", "qu")} end as xu,
      case when live then {least(then("D", "3", "qa"), then("R", "2 + cut", "qu"), f"case c when 'u' then {then('K', 'cut', 'qu')} else '9' end")}
        else {then("D", "3", "qa")} end as xa
    from (select k.*, r.c, r.fault not in ('blank', 'duplicate') as live, (r.fault = 'truncated')::int as cut
      from costs k join rows r on r.conv_id is not distinct from k.conv_id and r.i = k.i)
  )
), best as (
  select conv_id, q0[:9]::bigint as cost, q0[10:] as audit from costs where i = 0
), edits as (
  select *, count(*) filter (edit <> 'I') over up_to as i, count(*) filter (edit <> 'D') over up_to as o
  from (select conv_id, unnest(range(1, length(audit) + 1)) as p, audit[p] as edit from best)
  window up_to as (partition by conv_id order by p rows unbounded preceding)
), shaped as (
  select e.*, r.role, r.text, bool_or(o = 1 and edit = 'K' and r.c = 's') over (partition by e.conv_id) as has_system
  from edits e left join rows r on edit in ('K', 'R') and r.conv_id is not distinct from e.conv_id and r.i = e.i
  where edit <> 'D'
), repaired as (
  select conv_id, sha256(string_agg(case when edit = 'K' then role
      when (o - coalesce(has_system, false)::int) % 2 = 1 then 'user' else 'assistant' end
    || ':' || coalesce(text, ''), chr(10) order by p)) as repaired_sha256
  from shaped group by conv_id
), faults as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from rows group by conv_id
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
  coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join faults f on f.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id
left join repaired r on r.conv_id is not distinct from o.conv_id
"""


@register("op12_viterbi_repair", SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return dialogue.audit_report(damaged(turns), turns)
