"""Blocked windows against plain windows, and per-key aggregates."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tickhouse.operators import analytics, series


@pytest.fixture(scope="module")
def prices(spark):
    """A third of all rows belongs to one symbol; times are irregular."""
    rng = random.Random(7)
    data, at = [], 0
    for i in range(3000):
        at += rng.choice([1, 5, 60, 4000])
        symbol = "HOT" if i % 3 == 0 else f"S{rng.randrange(40)}"
        data.append((symbol, at, round(rng.uniform(1, 100), 2)))
    df = spark.createDataFrame(data, "symbol string, at long, v double")
    return df.withColumn("t", F.timestamp_seconds("at")).cache()


def plain():
    return Window.partitionBy("symbol").orderBy("t")


@pytest.mark.parametrize("block", [1, 6, 8, 13, 100, 100_000])
def test_parts_give_the_plain_windows(prices, block):
    frame = plain().rowsBetween(-6, 0)
    want = prices.select(
        "symbol", "t", F.round(F.avg("v").over(frame), 9), F.round(F.stddev_samp("v").over(frame), 9)
    )
    got = series.rolling_features(prices, "symbol", "t", ["v"], 7, block=block)
    got = got.select("symbol", "t", F.round("v_rolling_mean", 9), F.round("v_rolling_std", 9))
    assert rows(got) == rows(want)


def test_a_series_inside_one_hour_with_tied_times(spark):
    data = [("HOT", i // 3, i, float(i % 17 + 1)) for i in range(3000)] + [("B", 5, 0, 1.0), (None, 5, 1, 2.0)]
    df = spark.createDataFrame(data, "symbol string, at long, id long, v double")
    df = df.select("symbol", F.timestamp_millis("at").alias("t"), "id", "v")
    got = series.trailing(
        df, "symbol", "t", 5, lambda w: {"past": F.collect_list("id").over(w.rowsBetween(-5, -1))}, block=40
    )
    past = {r.id: r.past for r in got.filter("symbol = 'HOT'").collect()}
    assert len(past) == 3000 and got.count() == 3002
    # Each row is behind exactly one other, in order of time; rows of one time in any order.
    before = {i: p[-1] for i, p in past.items() if p}
    assert len(before) == 2999 and len(set(before.values())) == 2999
    for i, p in past.items():
        assert len(p) == 5 or i < 6
        assert all(a // 3 <= b // 3 for a, b in zip(p, [*p[1:], i]))
        assert not p or past[p[-1]][-4:] == p[:-1][-4:]
    assert got.filter("symbol is null").first().past is None


@pytest.mark.parametrize("block", [1, 2, 7, 5000])
def test_changes(prices, block):
    last = F.lag("v").over(plain())
    want = prices.select("symbol", "t", F.round((F.col("v") - last) / last * 100, 9))
    got = series.pct_changes(prices, "symbol", "t", ["v"], block=block)
    assert rows(got.select("symbol", "t", F.round("v_change_pct", 9))) == rows(want)


def test_vectors(prices):
    past = F.collect_list("v").over(plain().rowsBetween(-60, -1))
    want = prices.select("symbol", "t", past.alias("w"), "v").filter(F.size("w") == 60)
    for block in (20, 64):
        got = series.sequence_windows(prices, "symbol", "t", "v", 60, block=block)
        assert rows(got) == rows(want) and got.count() > 900


def test_scaling_and_performance(spark):
    df = spark.createDataFrame(
        [("A", 1, 5.0), ("A", 2, 10.0), ("A", 3, 7.5), ("B", 1, 3.0), ("B", 2, 3.0), ("C", 1, None)],
        "symbol string, t int, v double",
    )
    scaled = series.min_max_scale(df, "symbol", "v").select("symbol", "t", "scaled")
    assert rows(scaled) == [
        ("A", 1, 0.0), ("A", 2, 1.0), ("A", 3, 0.5), ("B", 1, 0.0), ("B", 2, 0.0), ("C", 1, None)
    ]
    rel = series.relative_performance(df, "symbol", "t", "v").select("symbol", "t", "performance")
    assert rows(rel)[:3] == [("A", 1, 100.0), ("A", 2, 200.0), ("A", 3, 150.0)]


def test_null_is_a_partition_of_its_own(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("A", 1, 7)], "k string, t int, v int")
    got = series.first_last(df, ["k"], ["t"], ["v"])
    assert rows(got.select("k", "v", "first_v", "last_v")) == [
        ("A", 7, 7, 7), (None, 5, 5, 6), (None, 6, 5, 6)
    ]


def test_correlation_matches_the_builtin(prices):
    hours = prices.groupBy("symbol", F.date_trunc("day", "t").alias("open_time")).agg(
        (F.avg("v") + 60000).alias("close")
    ).cache()
    names = ["HOT", "S1", "S2", "MISSING"]
    got = {
        (r.symbol_a, r.symbol_b): r.correlation
        for r in analytics.correlation_matrix(hours, names).collect()
    }
    assert len(got) == 16
    a, b = hours.alias("a"), hours.alias("b")
    joined = a.join(b, F.col("a.open_time") == F.col("b.open_time"))
    want = joined.groupBy(F.col("a.symbol").alias("x"), F.col("b.symbol").alias("y")).agg(
        F.corr("a.close", "b.close").alias("c")
    )
    for r in want.filter(F.col("x").isin(names) & F.col("y").isin(names)).collect():
        assert got[r.x, r.y] == pytest.approx(r.c, abs=1e-7)
    assert got["HOT", "MISSING"] is None and got["MISSING", "MISSING"] is None
    assert got["S1", "S2"] == got["S2", "S1"]


def test_histogram_bins(spark):
    df = spark.createDataFrame(
        [("A", float(v)) for v in range(11)] + [("B", 3.0), ("B", 3.0)], "symbol string, close double"
    )
    got = rows(analytics.price_histogram(df, 5))
    assert [r for r in got if r[0] == "A"] == [
        ("A", i, 2.0 * i, 2.0 * i + 2, 3 if i == 4 else 2) for i in range(5)
    ]
    assert [r for r in got if r[0] == "B"] == [("B", 0, 3.0, 3.0, 2)]


def test_report_and_error(spark):
    df = spark.createDataFrame(
        [("p", "p"), ("p", "n"), ("n", "n"), ("x", "n")], "said string, was string"
    )
    got = {r.label: r for r in analytics.classification_report(df, "said", "was").collect()}
    assert (got["p"].precision, got["p"].recall, got["p"].support) == (0.5, 1.0, 1)
    assert (got["n"].precision, got["n"].f1) == (1.0, 0.5)
    assert (got["x"].precision, got["x"].support, got["x"].f1) == (0.0, 0, 0.0)
    numbers = spark.createDataFrame([(1.0, 4.0), (2.0, 6.0)], "a double, b double")
    assert analytics.forecast_error(numbers, "a", "b").first().rmse == pytest.approx(12.5 ** 0.5)
