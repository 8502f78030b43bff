"""Tiled correlations, frequent words by summaries and price classes by sketches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickhouse.operators import analytics

NAMES = [f"S{i}" for i in range(7)]


@pytest.fixture(scope="module")
def closes(spark):
    """Seven related series over six days on a high level, with gaps, nulls and a constant one."""
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.expr("make_dt_interval(0, cast(hour as int))")
    symbol = F.col("id") % 8
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    wave = F.sin(F.col("hour") / 5) * symbol
    close = F.when(symbol == 3, F.lit(7.0)).when(noise > 0.9, None).otherwise(60000 + wave + noise)
    rows = spark.range(8 * 24 * 6).withColumn("hour", F.floor(F.col("id") / 8))
    return (
        rows.select(F.concat(F.lit("S"), symbol).alias("symbol"), at.alias("open_time"), close.alias("close"), "id")
        .filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) > 0)
        .repartition(3)
    )


def plain(closes, first_day=1):
    frame = closes.filter(F.dayofmonth("open_time") >= first_day).toPandas()
    wide = frame.pivot(index="open_time", columns="symbol", values="close").astype("float64")
    return wide.reindex(columns=NAMES).corr(min_periods=2)


def same(got, want):
    got = {(r.symbol_a, r.symbol_b): r.correlation for r in got.collect()}
    assert len(got) == len(NAMES) ** 2
    for (a, b), value in got.items():
        if "S3" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[a, b], abs=1e-6)


@pytest.mark.parametrize("tile", [1, 3, 7])
def test_tiles_give_the_plain_correlations(closes, tile):
    same(analytics.correlation_matrix(closes, NAMES, tile=tile), plain(closes))


def test_a_range_of_days_is_merged_from_stored_moments(closes, folder):
    path = folder("moments")
    analytics.tile_moments(closes, NAMES, tile=3, slices=2).write.partitionBy("day").parquet(path)
    stored = closes.sparkSession.read.parquet(path)
    assert stored.groupBy("day", "a", "b").count().agg(F.max("count")).first()[0] <= 2
    same(analytics.correlations(stored.filter("day >= '2024-01-04'"), NAMES), plain(closes, 4))


def test_a_day_without_rows_has_no_moments(closes):
    empty = analytics.correlation_matrix(closes.limit(0), NAMES, tile=2)
    assert {r.correlation for r in empty.collect()} == {None}


@pytest.fixture(scope="module")
def texts(spark):
    """Three words of falling frequency in a long tail of words that occur once or twice."""
    number = F.col("id").cast("string")
    often = F.when(F.col("id") % 2 == 0, "alpha").when(F.col("id") % 3 == 0, "gamma").otherwise("delta")
    tail = F.translate(F.concat(F.lit("tail"), F.floor(F.col("id") / 2).cast("string")), "0123456789", "abcdefghij")
    return spark.range(6000).select(F.concat_ws(" ", often, tail, number).alias("text")).repartition(4)


@pytest.mark.parametrize("n, counters", [(3, 4), (3, 64), (3, 1 << 14), (40, 8), (1, 1)])
def test_frequent_words_are_exact(texts, n, counters):
    want = analytics.word_counts(texts, "text").orderBy(F.desc("count"), "word").limit(n)
    got = analytics.word_frequency(texts, "text", n, counters)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_a_flat_vocabulary_is_counted_whole(texts, monkeypatch):
    monkeypatch.setattr(analytics, "MOST_COUNTERS", 16)
    want = analytics.word_counts(texts, "text").orderBy(F.desc("count"), "word").limit(50)
    got = analytics.word_frequency(texts, "text", 50, 8)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_a_task_sends_no_more_than_its_counters(texts):
    kept = analytics.kept_words(texts, "text")
    summaries = analytics.frequent_summaries(kept, 10, read=50)
    tasks = texts.rdd.getNumPartitions()
    assert kept.distinct().count() > 3000 and summaries.count() <= tasks * 11
    # Bounds hold from both sides.
    cut = summaries.agg(F.sum("cut")).first()[0]
    least = {r.word: r.least for r in summaries.groupBy("word").agg(F.sum("least").alias("least")).collect()}
    for word, count in analytics.word_counts(texts, "text").collect():
        assert least.get(word, 0) <= count <= least.get(word, 0) + cut


def test_no_words(spark):
    empty = spark.createDataFrame([(None,), ("",), ("of the",)], "text string")
    assert analytics.word_frequency(empty, "text").collect() == []
    assert analytics.word_frequency(empty.limit(0), "text").collect() == []


def test_price_classes_of_equal_depth(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("double")
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.expr("make_dt_interval(0, 0, cast(id as int))")
    prices = spark.range(60000).select(F.lit("A").alias("symbol"), at.alias("open_time"), noise.alias("close"))
    flat = spark.range(5).select(F.lit("B").alias("symbol"), at.alias("open_time"), F.lit(2.0).alias("close"))
    none = spark.range(5).select(F.lit("C").alias("symbol"), at.alias("open_time"), F.lit(None).cast("double").alias("close"))
    sketches = analytics.price_sketches(prices.unionByName(flat).unionByName(none)).cache()
    assert sketches.filter("symbol = 'A'").count() == 42
    got = analytics.price_quantiles(sketches, 10).orderBy("symbol", "bin").collect()
    values = np.sort([r.close for r in prices.collect()])
    for r in got[:10]:
        share = np.searchsorted(values, r.bin_end, "right") / len(values)
        assert abs(share - (r.bin + 1) / 10) <= analytics.RANK_ERROR and r.rows == 60000
    assert got[0].bin_start == values[0] and got[9].bin_end == values[-1]
    assert [(r.symbol, r.bin_start, r.bin_end, r.rows) for r in got[10:]] == [("B", 2.0, 2.0, 5)] * 10
