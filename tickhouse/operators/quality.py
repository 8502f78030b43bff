"""Data tests: each returns the rows that fail; ``run_assertions`` reports them all."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.session import settle

# Keys of a page of the bit table, on average, and keys that a task gathers before it writes pages.
PAGE_KEYS = 1 << 20
RUN_KEYS = 1 << 22


def low_le_high(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("low_price") > F.col("high_price"))


def unique_symbol_date(summary: DataFrame) -> DataFrame:
    return unique(summary, ["symbol", "date"])


def score_range(market: DataFrame) -> DataFrame:
    return market.filter(~F.col("avg_sentiment_score").between(-1, 1))


def volume_positive(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("total_volume") <= 0)


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls per column, counted in one pass; columns without any are not listed."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in cols])
    cells = [
        F.struct(F.lit(name).alias("column"), F.col(name).alias("nulls")) for name in cols
    ]
    return counts.select(F.inline(F.array(*cells))).filter(F.col("nulls") > 0)


def repeated(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that occur more than once, with how often, by shuffling every value."""
    return df.groupBy(*cols).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)


def unique(
    df: DataFrame, cols: Sequence[str], page_keys: int = PAGE_KEYS, run_keys: int = RUN_KEYS
) -> DataFrame:
    """Values that occur more than once, with how often; null is a value like any other.

    Where nearly all values differ, :func:`repeated` would shuffle nearly all of them for a short
    result. Here only suspects are shuffled: values whose hash occurs twice. Their counts are exact,
    because a value that occurs twice has a hash that does, and suspects are compared as they are.
    """
    suspects = settle(suspect_hashes(df, cols, page_keys, run_keys), "suspects")
    hashed = df.select(*cols, F.xxhash64(*cols).alias("_hash"))
    # A short list of suspects is broadcast by its written size, and then no other row moves.
    return repeated(hashed.join(suspects, "_hash", "left_semi"), cols)


def suspect_hashes(
    df: DataFrame, cols: Sequence[str], page_keys: int = PAGE_KEYS, run_keys: int = RUN_KEYS
) -> DataFrame:
    """``_hash``: every 64-bit hash of ``cols`` that two or more rows have, once.

    The table of hashes is cut into pages by their upper bits, as many as the number of rows asks for.
    A task sorts ``run_keys`` hashes at a time and writes for each page the hashes that it saw
    once and those that it saw again; a hot value is two entries of a run, however often it occurs.
    The pages of all runs meet in one group of about ``page_keys`` hashes.
    """
    pages = max(1, -(-df.count() // page_keys))
    bits = max(1, (pages - 1).bit_length())

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            held.append(hashes)
            size += len(hashes)
            if size >= run_keys:
                yield _paged(np.concatenate(held), bits)
                held, size = [], 0
        if size:
            yield _paged(np.concatenate(held), bits)

    def meet(page: pa.Table) -> pa.Table:
        once, again = (
            [np.frombuffer(part.as_buffer(), np.uint64) for part in page.column(name)]
            for name in ("once", "again")
        )
        seen = np.sort(np.concatenate(once))
        twice = [seen[1:][seen[1:] == seen[:-1]], *again]
        return pa.table({"_hash": np.unique(np.concatenate(twice)).view(np.int64)})

    hashes = df.select(F.xxhash64(*cols).alias("_hash"))
    paged = hashes.mapInArrow(runs, "page int, once binary, again binary")
    return paged.groupBy("page").applyInArrow(meet, "_hash long")


def _paged(hashes: np.ndarray, bits: int) -> pa.RecordBatch:
    """A row per page with its distinct hashes, ascending, and those that occur again."""
    values, times = np.unique(hashes, return_counts=True)
    page = (values >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, page[1:] != page[:-1]])
    ends = np.r_[starts[1:], len(values)]
    again = times > 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(page[starts], pa.int32()),
            pa.array([values[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            pa.array([values[a:b][again[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary()),
        ],
        names=["page", "once", "again"],
    )


@dataclass(frozen=True)
class Rule:
    """A test of one table: a predicate that failing rows satisfy, or columns to be unique."""

    name: str
    table: str
    fails: Column | None = None
    unique: tuple[str, ...] = ()


def gold_rules() -> list[Rule]:
    """The declared tests of the gold tables."""
    bar = ("symbol", "date", "open_price", "high_price", "low_price", "close_price", "total_volume")
    required = {
        "daily_market_summary": bar,
        "gold_daily_ohlcv": bar,
        "gold_latest_prices": ("symbol", "latest_price", "latest_volume_24h", "last_updated"),
        "market_sentiment": (
            "sentiment_date", "symbol", "avg_sentiment_score", "total_articles",
            "positive_count", "negative_count", "neutral_count",
        ),
        "gold_dashboard_stats": ("symbol", "latest_price", "last_updated", "active_coins"),
    }
    rules = [
        Rule(f"not_null_{col}", table, F.col(col).isNull())
        for table, cols in required.items()
        for col in cols
    ]
    return rules + [
        Rule("unique_symbol", "gold_latest_prices", unique=("symbol",)),
        Rule("unique_symbol", "gold_dashboard_stats", unique=("symbol",)),
        Rule("unique_symbol_date", "daily_market_summary", unique=("symbol", "date")),
        Rule(
            "low_le_high", "daily_market_summary", F.col("low_price") > F.col("high_price")
        ),
        Rule("volume_positive", "daily_market_summary", F.col("total_volume") <= 0),
        Rule("score_range", "market_sentiment", ~F.col("avg_sentiment_score").between(-1, 1)),
    ]


def run_assertions(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rule, table, failing_rows, passed.

    All row rules of a table share one pass over it. Gold tables have a row per symbol and day, so their
    keys are compared by one aggregation, without a search for suspects first.
    """
    reports = []
    for table, df in tables.items():
        mine = [rule for rule in rules if rule.table == table]
        by_row = [rule for rule in mine if rule.fails is not None]
        if by_row:
            counts = df.agg(
                *[F.count_if(rule.fails).alias(f"r{i}") for i, rule in enumerate(by_row)]
            )
            cells = [
                F.struct(F.lit(rule.name).alias("rule"), F.col(f"r{i}").alias("failing_rows"))
                for i, rule in enumerate(by_row)
            ]
            reports.append(
                counts.select(F.inline(F.array(*cells))).withColumn("table", F.lit(table))
            )
        for rule in mine:
            if rule.unique:
                reports.append(
                    repeated(df, rule.unique)
                    .agg(F.count("*").alias("failing_rows"))
                    .select(
                        F.lit(rule.name).alias("rule"), "failing_rows", F.lit(table).alias("table")
                    )
                )
    report = reduce(DataFrame.unionByName, reports)
    return report.select("rule", "table", "failing_rows", (F.col("failing_rows") == 0).alias("passed"))
