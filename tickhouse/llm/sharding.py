"""Shards by jump consistent hashing, in column expressions only.

A key's shard is found by a walk over shard counts: at each stop the key's own sequence of
pseudo-random numbers says at which larger count the key would next move. The last stop below
the number of shards is its shard. There is no table of shards, and one more shard takes a key only
if the walk's next stop is exactly that shard; no key moves between old ones.

The walk's generator is ``x -> 2862933555777941757 x + 1`` modulo 2^64. Spark's long multiplication
does not wrap under ANSI rules, so a number is held as two halves of 32 bits and the multiplier is
applied in pieces of 16 bits, whose products fit.

Places within shards are numbered from one sort: rows are ordered by shard and key over all
partitions, so a shard's rows are neighbours, and a row's place is its place in its partition
plus the shard's rows in the partitions before. A shard, or a key, with a third of all rows is
spread over partitions like any other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.scratch import Scratch

LAW = "key"
# Bytes that a row takes besides its text.
ROW_BYTES = 16

# The generator's multiplier in pieces of 16 bits, lowest first.
M0, M1, M2, M3 = 0xB0FD, 0x87B0, 0x2EE6, 0x27BB
_LOW16, _LOW32 = 0xFFFF, 0xFFFFFFFF
# Steps tried for every key. A walk has about ln(shards) stops, the rest is for the few longer ones.
LAP = 64


def _let(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _low(x: Column, mask: int) -> Column:
    return x.bitwiseAND(F.lit(mask).cast("long"))


def _next_number(high: Column, low: Column, use) -> Column:
    """``use`` of the halves of the number after (high, low)."""

    def rest(t):
        carry = F.shiftright(t["b"], 16)
        upper = (
            high * M0
            + F.shiftleft(_low(high * M1, _LOW16), 16)
            + low * M2
            + F.shiftleft(_low(low * M3, _LOW16), 16)
            + carry
        )
        lower = F.shiftleft(_low(t["b"], _LOW16), 16) + _low(t["a"], _LOW16)
        return _let(_low(upper, _LOW32), lambda h: use(h, lower))

    first = low * M0 + 1
    pair = _let(
        first, lambda a: F.struct(a.alias("a"), (low * M1 + F.shiftright(a, 16)).alias("b"))
    )
    return _let(pair, rest)


def _walk(shards: int, start: Column, steps: int) -> Column:
    """The walk from ``start`` (high, low, stop, next) until the next stop is no shard."""

    def step(at, _):
        def moved(high, low):
            share = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1)
            return F.struct(
                high.alias("high"),
                low.alias("low"),
                at["next"].alias("stop"),
                F.floor((at["next"] + 1) * share).cast("long").alias("next"),
            )

        go = _next_number(at["high"], at["low"], moved)
        return F.when(at["next"] < shards, go).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def jump_shard(key: Column, shards: int) -> Column:
    """struct(shard, grown) of a long key: its shard of ``shards``, and of one more.

    Depends on the key and the number of shards alone; a null key counts as 0. Stops only grow, so
    ``shards`` steps always reach the end of a walk.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        _low(F.shiftright(key, 32), _LOW32).alias("high"),
        _low(key, _LOW32).alias("low"),
        F.lit(-1).cast("long").alias("stop"),
        F.lit(0).cast("long").alias("next"),
    )
    walk = _walk(shards, start, min(shards, LAP))
    if shards > LAP:
        walk = _let(walk, lambda at: F.when(at["next"] < shards, _walk(shards, at, shards)).otherwise(at))

    def read(at):
        grown = F.when(at["next"] == shards, F.lit(shards)).otherwise(at["stop"])
        return F.struct(at["stop"].cast("int").alias("shard"), grown.cast("int").alias("grown"))

    return _let(walk, read)


def with_shard(rows: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``rows`` with the shard of each row's key; a column of that name is replaced."""
    return rows.withColumn(name, jump_shard(F.col(key), shards)["shard"])


def moved_rows(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """The rows that one more shard takes; about one in ``shards`` + 1, all others stay."""
    return rows.where(jump_shard(F.col(key), shards)["grown"] == shards)


def write_shards(rows: DataFrame, key: str, shards: int, folder: str) -> None:
    """Write ``rows`` as Parquet, one folder ``shard=<n>`` each; tasks cut large shards into files."""
    placed = with_shard(rows, key, shards)
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)


def add_shard(spark, folder: str, grown: str, key: str, shards: int) -> None:
    """Write the data of ``folder`` over one more shard to ``grown``."""
    rows = spark.read.parquet(folder).drop("shard")
    write_shards(rows, key, shards + 1, grown)


def place_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) in its shard and place.

    Returns doc_id, size (UTF-8 bytes of the text and ``ROW_BYTES``), text_crc32, law ("key"),
    shard, slot (gapless from 0 within the shard, in order of doc_id with nulls first, then
    text_crc32 and size) and grown_shard (the shard if there were one more). A null text counts as
    empty, a null doc_id as 0; rows with equal doc_ids share a shard, whatever their texts; repeated rows
    take a place each. Extra columns are ignored; an empty table gives an empty result. The text is
    read once, everything after that handles a few numbers per row.
    """
    work = Scratch(docs.sparkSession)
    by = jump_shard(F.col("doc_id"), shards)
    rows = work.keep(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0).cast("long")).alias("text_crc32"),
            by.alias("at"),
            # Rows that are equal otherwise are told apart, so that they can be spread.
            F.monotonically_increasing_id().alias("tie"),
        ).select("doc_id", "size", "text_crc32", "at.shard", F.col("at.grown").alias("grown_shard"), "tie"),
        "rows",
    )
    order = ["shard", "doc_id", "text_crc32", "size", "tie"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    # The partition in the upper bits, the place in it in the lower 33; partitions are in order.
    ordered = work.keep(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = ordered.select("*", part.alias("part"), place.alias("place")).drop("at")
    counts = ordered.groupBy("shard", "part").agg(
        F.count("*").alias("n"), F.min("place").alias("first")
    )
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    shift = work.keep(
        counts.select("shard", "part", (before - F.col("first")).alias("shift")), "shifts"
    )
    placed = ordered.join(shift, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("place") + F.col("shift")).alias("slot"),
        "grown_shard",
    )
    return work.finish(placed)[0]
