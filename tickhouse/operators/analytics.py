"""Exploratory analytics: correlation, word frequency, distributions, seasonality, accuracy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import temporal
from tickhouse.functions.text import STOPWORDS, words
from tickhouse.operators.series import join_per_key
from tickhouse.session import settle

# Symbols of a tile, and tasks that share the times of a pair of tiles on one day.
TILE = 64
SLICES = 4
# Size of a price sketch, and the error of its ranks that the classes state. The published error of
# this size is 0.3 percent with 99 percent confidence.
SKETCH_K = 1024
RANK_ERROR = 0.01
# Words that a task's summary holds at first and at most, and words it reads between two prunings.
COUNTERS = 1 << 14
MOST_COUNTERS = 1 << 22
WORDS_READ = 1 << 20

MOMENTS = (
    "a int, b int, k double, shift_a double, shift_b double, mean_a double, mean_b double, "
    "m2_a double, m2_b double, c double"
)


def aligned_closes(
    klines: DataFrame, symbols: Sequence[str], time: str = "open_time", value: str = "close"
) -> DataFrame:
    """One row per time with one column per symbol; null where a symbol has no candle."""
    wanted = klines.filter(F.col("symbol").isin(list(symbols)))
    columns = [
        F.max(F.when(F.col("symbol") == symbol, F.col(value))).alias(f"s{i}")
        for i, symbol in enumerate(symbols)
    ]
    return wanted.groupBy(time).agg(*columns)


def pair_moments(wide: DataFrame, n: int) -> DataFrame:
    """Per task and pair of the columns ``s0 .. s<n-1>``: count, means and centred moments.

    A batch of rows is a matrix, and the sums of all pairs are a few products of it, so a task
    keeps n x n sums however many times it reads and emits one row per pair. Values are taken
    relative to each column's first one, so a level does not swallow a small spread and a constant
    column has moments of exactly zero.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shift, sums = None, None
        for batch in batches:
            x = batch.to_numpy(dtype="float64", na_value=np.nan)
            here = ~np.isnan(x)
            if shift is None:
                shift = np.full(n, np.nan)
            new = np.isnan(shift) & here.any(axis=0)
            shift[new] = x[here.argmax(axis=0)[new], np.flatnonzero(new)]
            x = np.where(here, x - shift, 0.0)
            m = here.astype("float64")
            part = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
            sums = part if sums is None else sums + part
        if sums is None:
            return
        count, first, second, cross = sums
        a, b = np.triu_indices(n)
        k = count[a, b]
        a, b, k = a[k > 0], b[k > 0], k[k > 0]
        sum_a, sum_b = first[a, b], first[b, a]
        yield pd.DataFrame(
            {
                "a": a.astype("int32"),
                "b": b.astype("int32"),
                "k": k,
                "shift_a": shift[a],
                "shift_b": shift[b],
                "mean_a": sum_a / k,
                "mean_b": sum_b / k,
                "m2_a": second[a, b] - sum_a * sum_a / k,
                "m2_b": second[b, a] - sum_b * sum_b / k,
                "c": cross[a, b] - sum_a * sum_b / k,
            }
        )

    return wide.mapInPandas(moments, MOMENTS)


def tile_moments(
    klines: DataFrame,
    symbols: Sequence[str],
    tile: int = TILE,
    time: str = "open_time",
    value: str = "close",
    slices: int = SLICES,
) -> DataFrame:
    """Moments of every pair of symbols per day, in a form that merges over any range of days.

    Returns day and the columns of :func:`pair_moments`; a pair has up to ``slices`` rows a day.
    Symbols are numbered by their place in ``symbols`` and cut into tiles. A time's values are one
    vector per tile; each pair of tiles is summed by the tasks of its day, which read their rows in order
    and hold the sums of one pair of tiles, whatever the number of symbols and times.
    """
    names = list(dict.fromkeys(symbols))
    spark = klines.sparkSession
    numbers = spark.createDataFrame(list(enumerate(names)), "_number int, symbol string")
    slot = F.col("_number") % tile
    cells = [F.max(F.when(slot == i, F.col(value))).cast("double") for i in range(min(tile, len(names)))]
    vectors = (
        klines.select("symbol", time, value)
        .join(numbers, "symbol")
        .groupBy(time, F.floor(F.col("_number") / tile).cast("int").alias("tile"))
        .agg(F.array(*cells).alias("v"))
    )
    at_once = vectors.groupBy(time).agg(F.collect_list(F.struct("tile", "v")).alias("tiles"))
    others = F.filter("tiles", lambda other: other["tile"] >= F.col("left.tile"))
    pairs = (
        at_once.select(time, "tiles", F.explode("tiles").alias("left"))
        .select(time, "left", F.explode(others).alias("right"))
        .select(
            temporal.day_of(F.col(time)).alias("day"),
            F.col("left.tile").alias("ta"),
            F.col("right.tile").alias("tb"),
            F.pmod(F.xxhash64(time), F.lit(slices)).alias("slice"),
            F.col("left.v").alias("va"),
            F.col("right.v").alias("vb"),
        )
    )
    keys = ["day", "ta", "tb"]
    in_order = pairs.repartition(*keys, "slice").sortWithinPartitions(*keys).drop("slice")

    def matrix(column: pa.Array) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
        return flat.reshape(len(column), -1)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            day, ta, tb = (batch.column(i).cast(pa.int32()).to_numpy() for i in range(3))
            va, vb = matrix(batch.column(3)), matrix(batch.column(4))
            new = (np.diff(day) != 0) | (np.diff(ta) != 0) | (np.diff(tb) != 0)
            cuts = np.r_[0, np.flatnonzero(new) + 1, len(day)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                if low == high:
                    continue
                here = (int(day[low]), int(ta[low]), int(tb[low]))
                if sums is None or sums.key != here:
                    if sums is not None:
                        yield sums.rows(tile)
                    sums = TileSums(here, va.shape[1], vb.shape[1])
                sums.add(va[low:high], vb[low:high])
        if sums is not None:
            yield sums.rows(tile)

    return in_order.mapInArrow(summed, f"day date, {MOMENTS}")


class TileSums:
    """Running sums of the products of two tiles' values on one day."""

    def __init__(self, key: tuple[int, int, int], n_a: int, n_b: int):
        self.key = key
        self.shift_a, self.shift_b = np.full(n_a, np.nan), np.full(n_b, np.nan)
        self.sums = np.zeros((6, n_a, n_b))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, in_a = _relative(a, self.shift_a)
        b, in_b = _relative(b, self.shift_b)
        self.sums += np.stack(
            [in_a.T @ in_b, a.T @ in_b, in_a.T @ b, (a * a).T @ in_b, in_a.T @ (b * b), a.T @ b]
        )

    def rows(self, tile: int) -> pa.RecordBatch:
        day, ta, tb = self.key
        a, b = np.nonzero(self.sums[0])
        if ta == tb:
            a, b = a[a <= b], b[a <= b]
        k, sum_a, sum_b, square_a, square_b, cross = self.sums[:, a, b]
        columns = [
            pa.array(np.full(len(a), day, np.int32)).cast(pa.date32()),
            pa.array((a + ta * tile).astype(np.int32)),
            pa.array((b + tb * tile).astype(np.int32)),
            k,
            self.shift_a[a],
            self.shift_b[b],
            sum_a / k,
            sum_b / k,
            square_a - sum_a * sum_a / k,
            square_b - sum_b * sum_b / k,
            cross - sum_a * sum_b / k,
        ]
        names = ["day", *[column.split()[0] for column in MOMENTS.split(", ")]]
        return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=names)


def _relative(x: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``x`` less each column's first value, which ``shift`` keeps, and where ``x`` has a value."""
    here = ~np.isnan(x)
    new = np.isnan(shift) & here.any(axis=0)
    shift[new] = x[here.argmax(axis=0)[new], np.flatnonzero(new)]
    return np.where(here, x - shift, 0.0), here.astype("float64")


def merged_moments(moments: DataFrame) -> DataFrame:
    """Moments of all tasks together per pair, merged one by one around their own means.

    A pair has one row per task. Means stay relative to the first row's values, so nothing is
    added to a large level and taken away again.
    """
    parts = F.collect_list(
        F.struct("k", "shift_a", "shift_b", "mean_a", "mean_b", "m2_a", "m2_b", "c")
    )

    def merge(done, part):
        k = done["k"] + part["k"]
        step_a = (part["shift_a"] - done["shift_a"]) + part["mean_a"] - done["mean_a"]
        step_b = (part["shift_b"] - done["shift_b"]) + part["mean_b"] - done["mean_b"]
        weight = done["k"] * part["k"] / k
        return F.struct(
            k.alias("k"),
            done["shift_a"].alias("shift_a"),
            done["shift_b"].alias("shift_b"),
            (done["mean_a"] + step_a * part["k"] / k).alias("mean_a"),
            (done["mean_b"] + step_b * part["k"] / k).alias("mean_b"),
            (done["m2_a"] + part["m2_a"] + step_a * step_a * weight).alias("m2_a"),
            (done["m2_b"] + part["m2_b"] + step_b * step_b * weight).alias("m2_b"),
            (done["c"] + part["c"] + step_a * step_b * weight).alias("c"),
        )

    grouped = moments.groupBy("a", "b").agg(parts.alias("parts"))
    rest = F.slice("parts", F.lit(2), F.size("parts"))
    return grouped.select("a", "b", F.aggregate(rest, F.col("parts")[0], merge).alias("m")).select(
        "a", "b", "m.*"
    )


def correlation_matrix(
    klines: DataFrame,
    symbols: Sequence[str],
    time: str = "open_time",
    value: str = "close",
    tile: int = TILE,
) -> DataFrame:
    """Pearson correlation of every ordered pair of the given symbols, over the times both have.

    Aligning by time is one shuffle of one row per symbol and time; tasks then reduce their rows to
    moments per pair. A join of the symbols by time would instead emit every pair at every time. A
    task holds the sums of one pair of tiles of symbols. Symbols of a single tile need no
    pairing: each task sums the aligned rows as they come. A pair is null with fewer than two common
    times or a constant series. The result has a cell for every pair of ``symbols``, which are a
    registry's coins, not the data's.
    """
    names = list(dict.fromkeys(symbols))
    if len(names) <= tile:
        wide = aligned_closes(klines, names, time, value).drop(time)
        return correlations(pair_moments(wide, len(names)), names)
    return correlations(tile_moments(klines, names, tile, time, value), names)


def correlations(moments: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """The correlation matrix of stored moments, those of any range of days together.

    ``symbols`` is the list that the moments were made with.
    """
    names = list(dict.fromkeys(symbols))
    merged = merged_moments(moments)
    spread_a, spread_b = F.col("m2_a"), F.col("m2_b")
    corr = F.when(
        (F.col("k") > 1) & (spread_a > 0) & (spread_b > 0),
        F.greatest(
            F.lit(-1.0), F.least(F.lit(1.0), F.col("c") / F.sqrt(spread_a) / F.sqrt(spread_b))
        ),
    )
    half = merged.select("a", "b", corr.alias("correlation"))
    mirrored = half.filter("a < b").select(
        F.col("b").alias("a"), F.col("a").alias("b"), "correlation"
    )
    known = half.unionByName(mirrored)
    # All cells of the matrix, also those of symbols that never met.
    listed = F.array(*[F.lit(name) for name in names])
    cells = (
        moments.sparkSession.range(len(names) ** 2)
        .select(
            (F.expr(f"id div {len(names)}")).cast("int").alias("a"),
            (F.col("id") % len(names)).cast("int").alias("b"),
        )
    )
    return cells.join(known, ["a", "b"], "left").select(
        F.get(listed, F.col("a")).alias("symbol_a"),
        F.get(listed, F.col("b")).alias("symbol_b"),
        "correlation",
    )


def kept_words(
    df: DataFrame, col: str, stopwords: Sequence[str] = STOPWORDS, min_chars: int = 4
) -> DataFrame:
    """``word``: every word of at least ``min_chars`` letters that is no stop word, with repeats."""
    return df.select(F.explode(words(F.col(col))).alias("word")).filter(
        (F.length("word") >= min_chars) & ~F.col("word").isin(list(stopwords))
    )


def word_counts(
    df: DataFrame, col: str, stopwords: Sequence[str] = STOPWORDS, min_chars: int = 4
) -> DataFrame:
    """How often each word of at least ``min_chars`` letters occurs, without stop words."""
    kept = kept_words(df, col, stopwords, min_chars)
    return kept.groupBy("word").agg(F.count("*").alias("count"))


def frequent_summaries(kept: DataFrame, counters: int, read: int = WORDS_READ) -> DataFrame:
    """Misra-Gries summaries of ``word``, one per task: word, least and cut.

    A task holds at most ``counters`` words between two prunings. Pruning takes the count of the first
    word beyond them from all and keeps what is left, so a word occurs at least ``least`` times in the
    task and at most as often more as all prunings took, which a row without a word says as ``cut``.
    """

    def prune(parts: list[pa.Table]) -> tuple[pa.Table, int]:
        held = pa.concat_tables(parts).group_by("word").aggregate([("least", "sum")])
        held = held.rename_columns(["word", "least"])
        if held.num_rows <= counters:
            return held, 0
        least = held.column("least").to_numpy()
        cut = int(np.partition(least, -counters - 1)[-counters - 1])
        left = held.set_column(1, "least", pa.array(least - cut))
        return left.filter(pa.array(least > cut)), cut

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, cut = [], 0, 0
        for batch in batches:
            counted = batch.column(0).cast(pa.large_string()).value_counts()
            parts.append(pa.table({"word": counted.field(0), "least": counted.field(1)}))
            size += len(counted)
            if size >= read:
                held, taken = prune(parts)
                parts, size, cut = [held], 0, cut + taken
        if parts:
            held, taken = prune(parts)
            word = pa.chunked_array([*held.column("word").chunks, pa.array([None], pa.large_string())])
            least = np.r_[held.column("least").to_numpy(), 0]
            cuts = np.r_[np.zeros(held.num_rows, np.int64), cut + taken]
            summary = pa.table({"word": word.cast(pa.string()), "least": least, "cut": cuts})
            yield from summary.to_batches()

    return kept.mapInArrow(summed, "word string, least long, cut long")


def word_frequency(df: DataFrame, col: str, n: int = 20, counters: int = COUNTERS) -> DataFrame:
    """The ``n`` most frequent words; equal counts in alphabetical order.

    Counting every word would shuffle the vocabulary of every task for a short list. Tasks send
    summaries of bounded size instead, whose sums bound every word's count from both sides. Only words
    whose upper bound reaches the n-th lower bound are counted, exactly and in a second read. A
    word in no summary occurs at most as often as all prunings took; while the n-th lower bound is
    not above that, the summaries are made again with four times the counters, and with no more
    than ``MOST_COUNTERS`` of them; a vocabulary flatter than that is counted whole.
    """
    kept = kept_words(df, col)
    while counters <= MOST_COUNTERS:
        summaries = settle(frequent_summaries(kept, counters), "frequent")
        # Two numbers come to the driver.
        cut = summaries.agg(F.sum("cut")).first()[0] or 0
        bounds = summaries.filter("word is not null").groupBy("word").agg(F.sum("least").alias("count"))
        top = bounds.orderBy(F.desc("count"), "word").limit(n)
        if cut == 0:
            return top
        listed, nth = top.agg(F.count("*"), F.min("count")).first()
        if listed == n and nth > cut:
            candidates = settle(bounds.filter(F.col("count") + cut >= nth).select("word"), "candidates")
            counted = kept.join(candidates, "word", "left_semi").groupBy("word")
            return counted.agg(F.count("*").alias("count")).orderBy(F.desc("count"), "word").limit(n)
        counters *= 4
    return word_counts(df, col).orderBy(F.desc("count"), "word").limit(n)


def price_histogram(klines: DataFrame, bins: int = 20, value: str = "close") -> DataFrame:
    """Candles per symbol and price class; classes divide each symbol's own price range."""
    ranged = join_per_key(
        klines.select("symbol", F.col(value).alias("_v")),
        ["symbol"],
        [F.min("_v").alias("lo"), F.max("_v").alias("hi")],
    )
    width = (F.col("hi") - F.col("lo")) / bins
    # The greatest value belongs to the last class; a constant series to the first.
    slot = F.when(
        F.col("hi") > F.col("lo"),
        F.least(F.floor((F.col("_v") - F.col("lo")) / width), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    return (
        ranged.filter(F.col("_v").isNotNull())
        .groupBy("symbol", slot.cast("int").alias("bin"), "lo", "hi")
        .agg(F.count("*").alias("count"))
        .select(
            "symbol",
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            "count",
        )
    )


def price_sketches(
    klines: DataFrame, time: str = "open_time", value: str = "close", k: int = SKETCH_K
) -> DataFrame:
    """symbol, day, rows and a mergeable sketch of the day's values; days without a value have no row."""
    known = klines.filter(F.col(value).isNotNull())
    return known.groupBy("symbol", temporal.day_of(F.col(time)).alias("day")).agg(
        F.count("*").alias("rows"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    )


def price_quantiles(sketches: DataFrame, classes: int = 20, k: int = SKETCH_K) -> DataFrame:
    """Price classes of equal depth per symbol, from the sketches of any range of days.

    Returns symbol, bin, bin_start, bin_end and rows, the number of values of the symbol. No row of
    prices is read again. The share of values up to a class's end differs from (bin + 1) / classes by at
    most ``RANK_ERROR``, but for a probability far below one percent (the sketch is random). The
    first start and the last end are the least and the greatest value.
    """
    ends = F.array(*[F.lit(i / classes) for i in range(classes + 1)])
    merged = sketches.groupBy("symbol").agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )
    edges = merged.select("symbol", "rows", F.kll_sketch_get_quantile_double("sketch", ends).alias("edges"))
    bins = edges.select("symbol", "rows", "edges", F.explode(F.sequence(F.lit(0), F.lit(classes - 1))).alias("bin"))
    return bins.select(
        "symbol",
        "bin",
        F.get("edges", F.col("bin")).alias("bin_start"),
        F.get("edges", F.col("bin") + 1).alias("bin_end"),
        "rows",
    )


def daily_volume(klines: DataFrame) -> DataFrame:
    return klines.groupBy("symbol", temporal.day_of(F.col("open_time")).alias("date")).agg(
        F.sum("volume").alias("volume")
    )


def article_counts(news: DataFrame, grain: str = "day") -> DataFrame:
    """Articles per ``hour``, ``day``, ``week``, ``month`` ..."""
    return news.groupBy(F.date_trunc(grain, "published_at").alias("period")).agg(
        F.count("*").alias("articles")
    )


def active_sources(news: DataFrame, n: int | None = None) -> DataFrame:
    """Articles per source, the most active first; the top ``n`` only on request."""
    counts = news.groupBy("source").agg(F.count("*").alias("articles"))
    ranked = counts.orderBy(F.desc("articles"), "source")
    return ranked if n is None else ranked.limit(n)


def seasonality(klines: DataFrame) -> DataFrame:
    """Mean close and volume per symbol, weekday (1 = Sunday) and hour."""
    opened = F.col("open_time")
    return klines.groupBy(
        "symbol", F.dayofweek(opened).alias("weekday"), F.hour(opened).alias("hour")
    ).agg(
        F.avg("close").alias("avg_close"),
        F.avg("volume").alias("avg_volume"),
        F.count("*").alias("candles"),
    )


def confusion_matrix(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    return df.groupBy(F.col(predicted).alias("predicted"), F.col(actual).alias("actual")).agg(
        F.count("*").alias("count")
    )


def classification_report(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Precision, recall, F1 and support per label, from the confusion counts alone."""
    cells = confusion_matrix(df, predicted, actual)
    hit = F.when(F.col("predicted") == F.col("actual"), F.col("count")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    roles = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("predicted").alias("label"),
                    hit.alias("hits"),
                    F.col("count").alias("said"),
                    none.alias("was"),
                ),
                F.struct(
                    F.col("actual").alias("label"),
                    none.alias("hits"),
                    none.alias("said"),
                    F.col("count").alias("was"),
                ),
            )
        )
    )
    totals = roles.groupBy("label").agg(
        F.sum("hits").alias("hits"), F.sum("said").alias("said"), F.sum("was").alias("support")
    )
    hits = F.col("hits").cast("double")
    zero = F.lit(0.0)
    return totals.select(
        "label",
        F.when(F.col("said") > 0, hits / F.col("said")).otherwise(zero).alias("precision"),
        F.when(F.col("support") > 0, hits / F.col("support")).otherwise(zero).alias("recall"),
        F.when(F.col("said") + F.col("support") > 0, hits * 2 / (F.col("said") + F.col("support")))
        .otherwise(zero)
        .alias("f1"),
        "support",
    )


def forecast_error(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error, over everything or per key."""
    error = F.col(actual) - F.col(predicted)
    return df.groupBy(*by).agg(F.sqrt(F.avg(error * error)).alias("rmse"))
