"""Ordered series per key: first/last values, scaling, trailing windows, changes.

A plain window over a key sorts all rows of that key in one task, and one symbol may hold a
third of a table. So whole-key values are aggregated and joined back, and trailing windows run
over parts of a series, whose first rows are computed again behind the last rows of the part before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from tickhouse.session import settle

# Rows of a part of a long series.
BLOCK = 1_000_000
# Parts that rows without a key or time are spread over.
LOOSE_PARTS = 64


def join_per_key(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Add aggregates of each key's rows to the rows; null is a key like any other.

    The aggregates are computed when this is called, so that their true size decides how they
    are joined.
    """
    totals = settle(df.groupBy(*keys).agg(*aggs), "per-key")
    names = [c for c in totals.columns if c not in keys]
    left, right = df.alias("l"), totals.alias("r")
    same = [F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys]
    return left.join(right, same).select("l.*", *[f"r.{name}" for name in names])


def first_last(
    df: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Add ``first_<col>`` and ``last_<col>`` of each partition to all of its rows.

    The frame is always the whole partition; the default frame of an ordered window ends at the
    current row and would return that row's own value as the last one.
    """
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    aggs = []
    for name in cols:
        aggs += [
            F.min_by(name, by).alias(f"first_{name}"),
            F.max_by(name, by).alias(f"last_{name}"),
        ]
    return join_per_key(df, part, aggs)


def partition_stats(df: DataFrame, part: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Add whole-partition aggregates, given by output name, to all rows."""
    return join_per_key(df, part, [agg.alias(name) for name, agg in aggs.items()])


def relative_performance(df: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Value in percent of the key's first value; null where that is 0."""
    started = join_per_key(df, [key], [F.min_by(value, time).alias("_start")])
    share = F.try_divide(F.col(value), F.col("_start")) * 100
    return started.withColumn("performance", share).drop("_start")


def min_max_scale(df: DataFrame, key: str, col: str, name: str = "scaled") -> DataFrame:
    """Scale each key's values to 0..1; a constant series becomes 0."""
    ranged = join_per_key(df, [key], [F.min(col).alias("_lo"), F.max(col).alias("_hi")])
    width = F.col("_hi") - F.col("_lo")
    scaled = F.when(width > 0, (F.col(col) - F.col("_lo")) / width).when(
        F.col(col).isNotNull(), F.lit(0.0)
    )
    return ranged.withColumn(name, scaled).drop("_lo", "_hi")


def split_points(df: DataFrame, key: str, time: str, lookback: int, block: int) -> DataFrame:
    """Times that cut the long series into parts of about ``block`` rows.

    Returns key, ``_splits``, ``_from`` and ``_steps``. Splits come from a sample of the two columns:
    of a series' sampled times, each once, every so many-th is a split. ``_from`` is, for each split,
    the time ``lookback`` places before it in the sample. Each sampled time has a row, so at least
    ``lookback`` rows lie from there to the split; on average a sixteenth of a part does.
    ``_steps`` has an element for each step of a binary search.
    """
    placed = df.select(key, time).filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    every = 16 * lookback + 32
    if block > every:
        placed = placed.sample(every / block, seed=1)
    else:
        every = max(block, lookback + 1)
    in_order = Window.partitionBy(key).orderBy(time)
    points = placed.distinct().select(
        key,
        F.row_number().over(in_order).alias("_number"),
        F.struct(F.col(time).alias("at"), F.lag(time, lookback).over(in_order).alias("from")).alias("_split"),
    )
    lists = (
        points.filter((F.col("_number") > lookback) & (F.col("_number") % every == 0))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("_split")).alias("_split"))
    )
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size("_split") + 1)).cast("int"))
    return lists.select(
        key,
        F.col("_split.at").alias("_splits"),
        F.col("_split.from").alias("_from"),
        steps.alias("_steps"),
    )


def part_of(time: str) -> Column:
    """How many ``_splits`` are not after ``time``, by binary search; 0 in a series without splits."""

    def halve(at, _):
        middle = F.shiftright(at["low"] + at["high"], 1)
        here = F.get("_splits", middle) <= F.col(time)
        closer = F.when(
            here, F.struct((middle + 1).alias("low"), at["high"].alias("high"))
        ).otherwise(F.struct(at["low"].alias("low"), middle.alias("high")))
        return F.when(at["low"] < at["high"], closer).otherwise(at)

    start = F.struct(F.lit(0).alias("low"), F.size("_splits").alias("high"))
    found = F.aggregate("_steps", start, halve)["low"]
    return F.when(F.col("_splits").isNull(), 0).otherwise(found)


def trailing(
    df: DataFrame,
    key: str,
    time: str,
    lookback: int,
    columns: Callable[[Window], Mapping[str, Column]],
    block: int = BLOCK,
) -> DataFrame:
    """Add columns computed over each row and the ``lookback`` rows before it in its series.

    ``columns`` gets the window specification (partitioned and ordered, without a frame). Long
    series are cut into parts of about ``block`` rows at sampled times, and the rows are shuffled
    once, by series and part. A part also gets the rows before its lower end from a time on that is
    known to hold ``lookback`` rows, so the result is that of the whole series. A part may be as short as
    one time, a series may lie inside one hour, and rows of one time are taken in the order of their hash.
    Rows without a key or time have no place in a series; they are kept with nulls in the added columns.
    """
    splits = settle(split_points(df, key, time, lookback, block), "splits")
    tie = F.xxhash64(*[f.name for f in df.schema.fields if not _has_map(f.dataType)])
    has_place = F.col(key).isNotNull() & F.col(time).isNotNull()
    # Rows without a place are no series and are spread.
    apart = F.pmod(tie, F.lit(LOOSE_PARTS)).cast("int")
    own = F.lit(True)
    if splits.isEmpty():
        part = F.when(has_place, 0).otherwise(apart)
        parted = df.select("*", part.alias("_part"), tie.alias("_tie"))
    else:
        placed = df.join(splits, key, "left").select(
            *df.columns, F.when(has_place, part_of(time)).otherwise(apart).alias("_at"), "_from", tie.alias("_tie")
        )
        # get() is null above the last split, and for a series without splits.
        copied = F.coalesce(has_place & (F.get("_from", F.col("_at")) <= F.col(time)), F.lit(False))
        parts = F.when(copied, F.array("_at", F.col("_at") + 1)).otherwise(F.array("_at"))
        parted = placed.select(*df.columns, "_at", "_tie", F.explode(parts).alias("_part"))
        own = F.col("_part") == F.col("_at")
    spec = Window.partitionBy(key, "_part").orderBy(time, "_tie")
    added = {name: F.when(has_place, column) for name, column in columns(spec).items()}
    return parted.withColumns(added).filter(own).drop("_part", "_at", "_tie")


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def sequence_windows(
    df: DataFrame, key: str, time: str, value: str, lookback: int = 60, **blocks
) -> DataFrame:
    """The ``lookback`` values before each row as a vector, with the row's own as target.

    Only rows with a full vector are kept.
    """

    def vector(spec):
        past = F.collect_list(value).over(spec.rowsBetween(-lookback, -1))
        return {"window": past, "target": F.col(value)}

    rows = trailing(df.select(key, time, value), key, time, lookback, vector, **blocks)
    return rows.filter(F.size("window") == lookback).select(key, time, "window", "target")


def rolling_features(
    df: DataFrame, key: str, time: str, cols: Sequence[str], n: int = 7, **blocks
) -> DataFrame:
    """Mean and standard deviation of each column over the last ``n`` rows."""

    def features(spec):
        frame = spec.rowsBetween(-(n - 1), 0)
        out = {}
        for name in cols:
            out[f"{name}_rolling_mean"] = F.avg(name).over(frame)
            out[f"{name}_rolling_std"] = F.stddev_samp(name).over(frame)
        return out

    return trailing(df, key, time, n - 1, features, **blocks)


def pct_changes(df: DataFrame, key: str, time: str, cols: Sequence[str], **blocks) -> DataFrame:
    """Change of each column from the previous row in percent; null on the first row."""

    def changes(spec):
        out = {}
        for name in cols:
            last = F.lag(name).over(spec)
            out[f"{name}_change_pct"] = F.when(last != 0, (F.col(name) - last) / last * 100)
        return out

    return trailing(df, key, time, 1, changes, **blocks)
