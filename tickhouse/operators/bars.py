"""Price bars: daily bars from candles, today's bar from ticks, and the market summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import temporal
from tickhouse.operators.dedup import latest_per_key

BAR = ("symbol", "date", "open_price", "high_price", "low_price", "close_price", "total_volume")


def daily_ohlcv(klines: DataFrame) -> DataFrame:
    """First open, highest high, lowest low, last close and volume per symbol and day.

    One hash aggregation whose buffers are all fixed-width: every task combines its rows to one
    per symbol and day before the single shuffle, however unevenly the symbols are traded.
    """
    opened = F.col("open_time")
    return klines.groupBy("symbol", temporal.day_of(opened).alias("date")).agg(
        F.min_by("open", opened).alias("open_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.max_by("close", opened).alias("close_price"),
        F.sum("volume").alias("total_volume"),
    )


def daily_ohlcv_incremental(klines: DataFrame, existing: DataFrame) -> DataFrame:
    """The bars table after recomputing the days from its last one on.

    Bars of recomputed (symbol, date) pairs replace the old ones; all others stay. The cut is a
    range on the raw time column, so it reaches the scan.
    """
    last = existing.agg(
        F.coalesce(F.max("date"), F.lit("1970-01-01").cast("date")).alias("last")
    ).scalar()
    recent = temporal.since_year(klines, last).filter(F.col("open_time") >= last)
    fresh = daily_ohlcv(recent).select(*BAR)
    kept = existing.join(fresh.select("symbol", "date"), ["symbol", "date"], "left_anti")
    return kept.select(*BAR).unionByName(fresh)


def daily_ohlcv_touched(klines: DataFrame, pairs: DataFrame) -> DataFrame:
    """The bars of the given (symbol, date) pairs only.

    What a load has to recompute when its rows may be older than the last bar, as those of a
    symbol that is filled in late.
    """
    days = pairs.select("symbol", "date").distinct()
    dated = klines.withColumn("date", temporal.day_of(F.col("open_time")))
    return daily_ohlcv(dated.join(days, ["symbol", "date"], "left_semi").drop("date"))


def intraday_ohlcv(ticks: DataFrame, as_of: Column) -> DataFrame:
    """The bar of day ``as_of`` from ticks.

    Its volume is the last rolling 24 h volume, not a sum: each tick already carries the total.
    """
    start = as_of.cast("date")
    when = F.col("event_time")
    today = temporal.on_day(ticks, start).filter((when >= start) & (when < F.date_add(start, 1)))
    bar = today.groupBy("symbol").agg(
        F.min_by("price", when).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", when).alias("close_price"),
        F.max_by("volume", when).alias("total_volume"),
    )
    return bar.withColumn("date", start)


def market_summary(daily: DataFrame, ticks: DataFrame, as_of: Column) -> DataFrame:
    """Daily bars before ``as_of`` plus the bar of ``as_of`` from ticks.

    Both hold a symbol and day once and no day is in both, so nothing is left to remove.
    """
    history = daily.filter(F.col("date") < as_of.cast("date")).select(*BAR)
    today = intraday_ohlcv(ticks, as_of).select(*BAR)
    return history.unionByName(today)


def latest_prices(ticks: DataFrame) -> DataFrame:
    """The newest price and volume per symbol of a ticks table that is unique per time."""
    when = F.col("event_time")
    return ticks.groupBy("symbol").agg(
        F.max_by("price", when).alias("latest_price"),
        F.max_by("volume", when).alias("latest_volume_24h"),
        F.max(when).alias("last_updated"),
    )


def merge_latest(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """The newest price per symbol of two ``latest_prices`` tables.

    Keeps the table current from new ticks alone; ticks that arrive late never win.
    """
    names = ("symbol", "latest_price", "latest_volume_24h", "last_updated")
    both = existing.select(*names).unionByName(fresh.select(*names))
    return latest_per_key(both, ["symbol"], "last_updated")
