"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

A sketch is a histogram over buckets that grow by a fixed factor, so any quantile is known to
within that relative error. Buckets are counted by one aggregation that combines in every task
before it shuffles, sketches merge by adding counts, and their size does not depend on the rows.

A document fails a rule if its value lies beyond the fence of its group. The rules in TAILS have
values that are mostly zero, so their quartiles say nothing: their fence is the ``TAIL`` quantile of
the group. The fence of the others is the upper quartile plus ``REACH`` times the quartiles' distance
(for the rules in BOTH, the lower quartile less as much, too).

Small groups borrow from coarser ones without a switch: a group's fence is the mean of its own and
its language's, weighted by its documents and ``PRIOR``, and so is a language's with that of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.arrays import Rolling, _SPACE, mix, text_blocks, word_spans
from tickhouse.session import settle

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

# Rule: least distance of its quartiles, for groups of values as good as equal; a tail needs none.
RULES = {
    "symbol_ratio": 0.0,
    "dup_line_ratio": 0.0,
    "repeat_ratio": 0.0,
    "word_length": 0.05,
}
# Fixed parameters of the method.
TAILS = ("symbol_ratio", "dup_line_ratio", "repeat_ratio")
TAIL = 0.95
BOTH = ("word_length",)
REACH = 4.0
GROWTH = 1.005
LEAST = 1e-4
# Documents that the coarser fence counts for.
PRIOR = 100


def line_spans(data: np.ndarray, starts: np.ndarray):
    """Start and end (without the line feed) of every line, and the lines of each text."""
    feeds = np.flatnonzero(data == 0x0A)
    first = np.concatenate([starts[:-1], feeds + 1])
    # The line of a text's start ends at its first feed or at the text's end.
    order = np.argsort(first, kind="stable")
    owner = np.concatenate(
        [np.arange(len(starts) - 1), np.searchsorted(starts, feeds, "right") - 1]
    )[order]
    first = first[order]
    next_feed = np.append(feeds, len(data))[np.searchsorted(feeds, first)]
    end = np.minimum(next_feed, starts[owner + 1])
    return first, end, owner


def count_block(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The COUNTS of every text, one row per text."""
    n = len(starts) - 1
    out = np.zeros((n, len(COUNTS)), np.int64)
    first, end, per_text = word_spans(data, starts)
    owner = np.repeat(np.arange(n), per_text)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data & 0xC0) != 0x80) & ~_SPACE[data], out=lead[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SYMBOL[data], out=symbols[1:])
    out[:, 0] = per_text
    out[:, 1] = lead[starts[1:]] - lead[starts[:-1]]
    out[:, 2] = symbols[starts[1:]] - symbols[starts[:-1]]
    hashes = Rolling(data, 1)
    # Lines with a word, equal to an earlier line of the text.
    a, b, line_owner = line_spans(data, starts)
    worded = np.searchsorted(first, b) > np.searchsorted(first, a)
    out[:, 5] = np.bincount(line_owner[worded], minlength=n)
    key = mix(hashes.between(a[worded], b[worded]) + line_owner[worded].astype(np.uint64))
    _, kept = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[kept] = False
    out[:, 3] = np.bincount(line_owner[worded][again], minlength=n)
    # Words in windows of three words that the text has twice or more.
    if len(first) >= 3:
        words = hashes.between(first, end)
        window = Rolling(words, 2).windows(3)
        inside = owner[: len(window)] == owner[2:]
        key = mix(window[inside] + owner[: len(window)][inside].astype(np.uint64))
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        at = np.flatnonzero(inside)[times[back] > 1]
        hit = np.zeros(len(first), bool)
        for k in range(3):
            hit[at + k] = True
        out[:, 4] = np.bincount(owner[hit], minlength=n)
    return out


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with the COUNTS of the whole text (null: none) as columns.

    Columns that were there under these names are replaced.
    """
    kept = [c for c in docs.columns if c not in (*COUNTS, "text")]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [count_block(data, starts) for _, _, data, starts in text_blocks(batch)]
            if not parts:
                continue
            table = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c) for c in np.ascontiguousarray(table.T))],
                names=[*kept, *COUNTS],
            )

    fields = [source.schema[c] for c in kept]
    schema = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return source.mapInArrow(count, schema)


def rule_values() -> dict[str, Column]:
    """The value of each rule; null where it is not defined (no words, no lines)."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "symbol_ratio": F.when(chars > 0, F.col("n_symbols") / chars),
        "dup_line_ratio": F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines")),
        "repeat_ratio": F.when(words > 0, F.col("n_repeat_words") / words),
        "word_length": F.when(words > 0, chars / words),
    }


def bucket_of(value: Column) -> Column:
    """The sketch's bucket: 0 up to LEAST, then one more per growth by GROWTH."""
    place = F.ceil(F.log(value / LEAST) / math.log(GROWTH))
    return F.when(value <= LEAST, F.lit(0)).otherwise(place).cast("int")


def value_of(bucket: Column) -> Column:
    """The middle value of a bucket."""
    return F.when(bucket == 0, F.lit(0.0)).otherwise(
        F.pow(F.lit(GROWTH), bucket.cast("double")) * (LEAST * 2 / (1 + GROWTH))
    )


def edge_of(bucket: Column) -> Column:
    """The largest value of a bucket."""
    return F.pow(F.lit(GROWTH), bucket.cast("double")) * LEAST


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The sketch of every rule per group: keys, rule, bucket, n (rows of ``rule_values``)."""
    entries = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])
    )
    return (
        rows.select(*keys, entries.alias("e"))
        .where(F.col("e.value").isNotNull())
        .groupBy(*keys, F.col("e.rule").alias("rule"), bucket_of(F.col("e.value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups: the counts of their buckets, added."""
    return sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str], prior: int) -> DataFrame:
    """low and high per group and rule, and their weight against a coarser fence of ``prior`` rows."""
    group = [*keys, "rule"]
    running = Window.partitionBy(*group).orderBy("bucket")
    whole = Window.partitionBy(*group)
    ranked = sketch.withColumn("upto", F.sum("n").over(running)).withColumn(
        "total", F.sum("n").over(whole)
    )

    def quantile(q, of=value_of):
        return F.min(F.when(F.col("upto") >= q * F.col("total"), of(F.col("bucket"))))

    quartiles = ranked.groupBy(*group).agg(
        quantile(0.25).alias("q1"),
        quantile(0.75).alias("q3"),
        quantile(TAIL, edge_of).alias("tail"),
        F.first("total").alias("total"),
    )
    least = F.lit(0.0)
    for rule, spread in RULES.items():
        least = F.when(F.col("rule") == rule, F.lit(spread)).otherwise(least)
    reach = REACH * F.greatest(F.col("q3") - F.col("q1"), least)
    low = F.when(F.col("rule").isin(*BOTH), F.col("q1") - reach)
    high = F.when(F.col("rule").isin(*TAILS), F.col("tail")).otherwise(F.col("q3") + reach)
    weight = F.col("total") / (F.col("total") + F.lit(prior))
    return quartiles.select(*group, low.alias("low"), high.alias("high"), weight.alias("weight"))


def blend(fine: Column, coarse: Column) -> Column:
    """The fence between two, by the weight of the finer one."""
    weight = fine["weight"]

    def mean(end):
        return (weight * fine[end] + (1 - weight) * coarse[end]).alias(end)

    return F.struct(mean("low"), mean("high"))


def thresholds(rows: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per (lang, source): a struct low_/high_ column per rule, blended with coarser ones."""
    fine = sketches(rows, ["lang", "source"])
    middle = merge(fine, ["lang"])
    coarse = merge(middle, [])
    fence = F.struct("low", "high", "weight")
    own = fences(fine, ["lang", "source"], prior).select("lang", "source", "rule", fence.alias("own"))
    by_lang = fences(middle, ["lang"], prior).select(
        F.col("lang").alias("l2"), F.col("rule").alias("r2"), fence.alias("by_lang")
    )
    overall = fences(coarse, [], prior).select(F.col("rule").alias("r3"), fence.alias("overall"))
    joined = (
        own.join(by_lang, own["lang"].eqNullSafe(F.col("l2")) & (own["rule"] == F.col("r2")))
        .join(overall, own["rule"] == F.col("r3"))
        .withColumn("by_lang", blend(F.col("by_lang"), F.col("overall")))
        .select("lang", "source", "rule", blend(F.col("own"), F.col("by_lang")).alias("fence"))
    )
    return joined.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("fence"))).alias(f"fence_{r}") for r in RULES]
    )


def judge(docs: DataFrame, min_words: int = 50, min_group: int = PRIOR) -> DataFrame:
    """``docs`` (text, lang, source and others) with COUNTS, base_failed, failed and kept.

    base_failed: fewer than ``min_words`` words, or more than half of them in repeated windows.
    failed lists the rules beyond the fences; kept is false if either says so. Fences are learned
    from documents that pass the base rules; next to a group's own fence, that of its language counts
    as ``min_group`` documents. Null languages and sources are groups like others, null and empty
    texts have no words, an empty table gives an empty result; every row is kept, columns
    of the added names are replaced, and the text is not returned.
    """
    added = ("base_failed", "failed", "kept")
    source = docs.drop(*added)
    for name in ("lang", "source"):
        if name not in source.columns:
            source = source.withColumn(name, F.lit(None).cast("string"))
    counted = settle(with_counts(source), "quality-counts")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    values = rule_values()
    measured = counted.select(
        "lang", "source", base.alias("base"), *[v.alias(r) for r, v in values.items()]
    )
    fence = thresholds(measured.where(~F.col("base")), min_group).select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        *[F.col(f"fence_{r}").alias(f"_{r}") for r in RULES],
    )
    joined = counted.join(
        fence,
        counted["lang"].eqNullSafe(F.col("_lang")) & counted["source"].eqNullSafe(F.col("_source")),
        "left",
    )
    failed = F.filter(
        F.array(
            *[
                F.when((v > F.col(f"_{r}.high")) | (v < F.col(f"_{r}.low")), F.lit(r))
                for r, v in values.items()
            ]
        ),
        lambda r: r.isNotNull(),
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in counted.columns],
        base.alias("base_failed"),
        failed.alias("failed"),
        (~base & (F.size(failed) == 0)).alias("kept"),
    )
