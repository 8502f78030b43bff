"""Incremental extraction against a high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import temporal


def new_rows(
    source: DataFrame,
    target: DataFrame,
    time_col: str,
    per_key: str | None = None,
) -> DataFrame:
    """Source rows newer than what the target holds; all of them while the target is empty.

    The global mark is one subquery that the scan's filter uses. With ``per_key`` every key has
    its own mark, so a key that is filled in late is not lost behind the others.
    """
    if per_key is None:
        kind = target.schema[time_col].dataType
        # The first day of all stands in for the mark of an empty target: a plain comparison is a bound
        # that the scan can use, "no mark or newer" is not.
        mark = target.agg(
            F.coalesce(F.max(time_col), F.lit("0001-01-01 00:00:00").cast(kind)).alias("mark")
        ).scalar()
        return temporal.since_year(source, mark).filter(F.col(time_col) > mark)
    marks = target.groupBy(per_key).agg(F.max(time_col).alias("_mark"))
    return (
        source.join(marks, per_key, "left")
        .filter(F.col("_mark").isNull() | (F.col(time_col) > F.col("_mark")))
        .drop("_mark")
    )
