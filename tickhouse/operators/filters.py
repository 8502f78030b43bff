"""Selections that several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def user_scope(df: DataFrame, user_id: int) -> DataFrame:
    """One user's rows."""
    return df.filter(F.col("user_id") == user_id)


def symbol_filter(df: DataFrame, registry: DataFrame, symbol: str | None = None) -> DataFrame:
    """Rows of registered symbols; of one symbol, in any case, when ``symbol`` is given."""
    known = registry.select(F.upper("symbol").alias("symbol"))
    if symbol is not None:
        wanted = symbol.upper()
        df, known = df.filter(F.col("symbol") == wanted), known.filter(F.col("symbol") == wanted)
    return df.join(known, "symbol", "left_semi")


def recent_window(df: DataFrame, time_col: str, as_of: Column, days: int = 7) -> DataFrame:
    """Rows not older than ``days`` days before ``as_of``."""
    return df.filter(F.col(time_col) >= as_of - F.expr(f"INTERVAL '{int(days)}' DAY"))


def latest_day(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the greatest date; a scalar subquery that Spark pushes into the scan."""
    newest = df.agg(F.max(date_col).alias("newest")).scalar()
    return df.filter(F.col(date_col) == newest)
