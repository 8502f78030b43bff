"""Query op1: chat formatting of all conversations, read back from the examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import chat
from tickhouse.llm.registry import register, table

# Fixed value: the text of conversation -1.
CONTROL = "</s>[INST] ok [/INST]"


def escaped(column: str) -> str:
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"


SQL = f"""
with all_turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all select -1, 0, 'user', '{CONTROL}'
  union all select -1, 1, 'assistant', '{CONTROL}'
), written as (
  select *, role = 'assistant' as reply,
    length('<|im_start|>' || replace({escaped("role")}, chr(10), '&#10;') || chr(10)
      || {escaped("text")} || '<|im_end|>' || chr(10)) as chars
  from all_turns
), running as (
  select *, sum(chars) over (partition by conv_id order by turn, role, text
    rows between unbounded preceding and current row) as so_far
  from written
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (reply), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (reply), '')) as loss_sha256,
  cast(coalesce(sum(so_far) filter (reply), 0) + sum(chars) as bigint) as formatted_chars
from running group by conv_id
"""


@register("op1_chat_prefix_targets", SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(chat.REPLY)).alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    examples = chat.prefix_examples(turns.unionByName(extra))
    closing = F.col("example").isNull()
    reply = chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    read = examples.select(
        "conv_id",
        F.length("formatted").alias("chars"),
        F.when(closing, chat.parse_turns(F.col("formatted"))).alias("turns"),
        F.when(~closing, F.struct("example", reply.alias("reply"))).alias("loss"),
    )
    per_conversation = read.groupBy("conv_id").agg(
        F.max("turns").alias("turns"),
        F.array_sort(F.collect_list("loss")).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(F.transform("losses", lambda x: x["reply"]), "")
    return per_conversation.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.col("formatted_chars"),
    )
