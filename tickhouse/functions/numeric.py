"""Ratios, guarded casts and score classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_change(start: Column, end: Column) -> Column:
    """Change from ``start`` to ``end`` in percent; 0 when ``start`` is not positive."""
    return F.when(start > 0, (end - start) / start * 100).otherwise(F.lit(0.0))


def share_pct(part: Column, total: Column, when_zero: float) -> Column:
    """``part`` in percent of ``total``, with a fixed answer when the total is not positive."""
    return F.when(total > 0, part / total * 100).otherwise(F.lit(when_zero))


def mood(score: Column, threshold: float = 0.2) -> Column:
    """Bullish above the threshold, Bearish below its negative, else Neutral."""
    return (
        F.when(score > threshold, "Bullish").when(score < -threshold, "Bearish").otherwise("Neutral")
    )


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def to_long(col: Column) -> Column:
    return col.try_cast("bigint")


def money(col: Column) -> Column:
    """The serving tables' DECIMAL(18,8); null when the number does not fit."""
    return col.try_cast("decimal(18,8)")
