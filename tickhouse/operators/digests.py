"""Order-free digests of groups of rows, and which groups differ between two of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HALF = 0xFFFFFFFF
PARTS = ("n", "low_1", "high_1", "low_2", "high_2")


def group_digests(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """keys and a digest of each group's rows as a multiset: their number and sums of two hashes.

    Sums do not depend on the order of the rows or on how tasks combine them, and unlike an exclusive
    or they see a row that is there twice. Hashes are summed in halves of 32 bits, which cannot
    overflow below two billion rows a group. Nulls count as values.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for seed in (1, 2):
        row = F.xxhash64(F.lit(seed), *cols)
        aggs += [
            F.sum(row.bitwiseAND(F.lit(_HALF))).alias(f"low_{seed}"),
            F.sum(F.shiftrightunsigned(row, 32)).alias(f"high_{seed}"),
        ]
    return df.groupBy(*keys).agg(*aggs)


def changed_groups(before: DataFrame, after: DataFrame, keys: Sequence[str], parts: Sequence[str] = PARTS) -> DataFrame:
    """keys and gone: the groups whose digests differ, that are new, or that are gone."""
    tagged = before.select(*keys, *parts, F.lit(0).alias("_after")).unionByName(
        after.select(*keys, *parts, F.lit(1).alias("_after"))
    )
    # Equal digests of a group meet in one aggregation: two rows, the same values.
    per_group = tagged.groupBy(*keys).agg(
        F.min(F.struct(*parts)).alias("low"),
        F.max(F.struct(*parts)).alias("high"),
        F.count("*").alias("sides"),
        F.max("_after").alias("last"),
    )
    same = (F.col("sides") == 2) & (F.col("low") == F.col("high"))
    return per_group.where(~same).select(*keys, (F.col("last") == 0).alias("gone"))


def file_stamps(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """One digest per partition of a table's list of files; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return group_digests(files, partition_by, ("path", "length", "modificationTime"))
