"""Deduplication and latest-row selection.

All of these keep the first row of an ordered ``row_number``. Spark plans that filter as a
group limit in front of the shuffle, so each task forwards at most one row per key and a key
that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key in the given order."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def dedup_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the one ``order_by`` puts first, so the choice is repeatable.

    Rows that tie, or no order at all, are settled by a hash of the row's content.
    """
    tie = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    return first_rows(df, keys, [*order_by, tie])


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """The whole row with the greatest ``order_col`` of every key."""
    return first_rows(df, keys, [F.col(order_col).desc_nulls_last(), *tiebreak])


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    return first_rows(df, keys, order)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
