"""Time conversions and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}


# Seconds of 0001-01-01 and 9999-12-31T23:59:59. An epoch outside overflows and would fail
# the whole job, so such a message gets a null time and is rejected by its quality rule.
MIN_SECONDS = -62135596800
MAX_SECONDS = 253402300799


def epoch_millis(col: Column, truncate_to: str | None = None) -> Column:
    """Epoch milliseconds to timestamp; ``truncate_to='second'`` drops the milliseconds."""
    inside = col.between(MIN_SECONDS * 1000, MAX_SECONDS * 1000)
    stamp = F.when(inside, F.timestamp_millis(col))
    return stamp if truncate_to is None else F.date_trunc(truncate_to, stamp)


def epoch_seconds(col: Column) -> Column:
    return F.when(col.between(MIN_SECONDS, MAX_SECONDS), F.timestamp_seconds(col))


def iso_timestamp(col: Column) -> Column:
    """ISO-8601 text to timestamp; text that is no timestamp becomes null instead of failing."""
    return F.try_to_timestamp(col)


def with_parts(df: DataFrame, time_col: str, parts: tuple[str, ...]) -> DataFrame:
    """Add the named calendar parts (``year``, ``month``, ``day``, ``hour``) of ``time_col``."""
    return df.withColumns({part: PARTS[part](F.col(time_col)) for part in parts})


def day_of(col: Column) -> Column:
    return F.to_date(col)


def day_start(col: Column) -> Column:
    return F.date_trunc("day", col)


def hour_start(col: Column) -> Column:
    return F.date_trunc("hour", col)


def format_date(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def format_utc(col: Column) -> Column:
    """API form of a date or timestamp: ``2026-05-01T00:00:00Z``."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def on_day(df: DataFrame, day: Column) -> DataFrame:
    """Name the day to a table partitioned by year, month, day, so that it reads no other.

    Spark does not derive partition columns from a condition on the time they were made of.
    """
    if not {"year", "month", "day"} <= set(df.columns):
        return df
    return df.filter(
        (F.col("year") == F.year(day))
        & (F.col("month") == F.month(day))
        & (F.col("day") == F.dayofmonth(day))
    )


def since_year(df: DataFrame, moment: Column) -> DataFrame:
    """The same for a table partitioned by year and everything from ``moment`` on."""
    return df.filter(F.col("year") >= F.year(moment)) if "year" in df.columns else df
