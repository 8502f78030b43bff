"""Daily bars of a tick stream that late ticks still reach, with a table of what came late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickhouse.functions import temporal
from tickhouse.operators.bars import BAR
from tickhouse.session import settle
from tickhouse.sources.lake import LakeTable
from tickhouse.streaming.ticks import EVERY_30_SECONDS, Trigger, _foreach

BAR_STATE = (
    "symbol string, date date, first struct<event_time: timestamp, offset: bigint, price: double>, "
    "last struct<event_time: timestamp, offset: bigint, price: double, volume: double>, "
    "high_price double, low_price double"
)
LATE = (
    "symbol string, price double, volume double, event_time timestamp, offset bigint, "
    "late_by_ms bigint, batch_id bigint"
)
# The newest event time of a batch, in microseconds.
MARKS = "batch_id bigint, newest bigint"


def bar_states(ticks: DataFrame) -> DataFrame:
    """What a bar is made of, in a form that two of one day can be merged into one.

    ``ticks`` has symbol, price, volume, event_time and offset.
    """
    first = F.struct("event_time", "offset", "price")
    last = F.struct("event_time", "offset", "price", "volume")
    return ticks.groupBy("symbol", temporal.day_of(F.col("event_time")).alias("date")).agg(
        F.min(first).alias("first"),
        F.max(last).alias("last"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
    )


def merge_states(one: DataFrame, other: DataFrame) -> DataFrame:
    """The states of all ticks behind either table; merging a table twice changes nothing."""
    return one.unionByName(other).groupBy("symbol", "date").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
    )


def bars_of(states: DataFrame) -> DataFrame:
    """The daily bars; like those of the stream, the volume is the last rolling total."""
    return states.select(
        "symbol",
        "date",
        F.col("first.price").alias("open_price"),
        "high_price",
        "low_price",
        F.col("last.price").alias("close_price"),
        F.col("last.volume").alias("total_volume"),
    ).select(*BAR)


def tables(spark, folder: str) -> tuple[LakeTable, LakeTable, LakeTable]:
    """Bar states, late ticks and marks below a folder."""
    base = folder.rstrip("/")
    return (
        LakeTable(spark, f"{base}/states", ["symbol", "date"], schema=BAR_STATE),
        LakeTable(spark, f"{base}/late", ["batch_id", "symbol", "event_time", "offset"], ["batch_id"], schema=LATE),
        LakeTable(spark, f"{base}/marks", ["batch_id"], schema=MARKS),
    )


def keep_bars_and_late(
    ticks: DataFrame, folder: str, checkpoint: str, delay: str = "1 hour", trigger: Trigger = EVERY_30_SECONDS
) -> StreamingQuery:
    """Keep bars current from every tick, and list those that came later than ``delay``.

    The built-in watermark drops late rows without a trace. Here the newest event time before each
    batch is a mark of its own; a tick that is more than ``delay`` behind it goes to the table of late
    ticks, with how late it was, and into its bar all the same, however long that day is over.
    Marks of the running batch and later ones are not looked at and all tables are keyed, so a batch
    that is repeated comes to the same result. Ticks without a symbol, price or time are left out.
    """
    spark = ticks.sparkSession
    states, late, marks = tables(spark, folder)
    names = ("symbol", "price", "volume", "event_time", "offset")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*names).dropna(subset=["symbol", "price", "event_time"])
        rows = settle(rows, "ticks")
        if rows.isEmpty():
            return
        at = F.unix_micros("event_time")
        newest = rows.agg(F.max(at)).first()[0]
        earlier = marks.read().filter(F.col("batch_id") < batch_id) if marks.exists() else None
        mark = None if earlier is None else earlier.agg(F.max("newest")).first()[0]
        if mark is not None:
            behind = F.lit(mark) - at
            found = rows.filter(F.timestamp_micros(F.lit(mark)) - F.expr(f"interval {delay}") > F.col("event_time"))
            late.upsert(
                found.select(
                    *names,
                    F.floor(behind / 1000).cast("bigint").alias("late_by_ms"),
                    F.lit(batch_id).cast("bigint").alias("batch_id"),
                )
            )
        fresh = settle(bar_states(rows), "states")
        if states.exists():
            held = states.read().join(fresh.select("symbol", "date"), ["symbol", "date"], "left_semi")
            fresh = settle(merge_states(held, fresh), "merged")
        states.upsert(fresh)
        marks.upsert(spark.createDataFrame([(batch_id, newest)], MARKS))

    return _foreach(ticks, write, checkpoint, trigger)
