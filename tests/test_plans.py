"""The physical plans scale: shuffles, pushed filters, limits in front of shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import ROOT  # noqa: F401
from tickhouse.operators import accounts, bars, dashboard, dedup, filters, incremental, mood, series
from tickhouse.operators import silver
from tickhouse.sources import lake
from workload.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|Single)", plan(df)))


@pytest.fixture(scope="module")
def candles(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("candles") / "k")
    tables.klines().write.parquet(path)
    return spark.read.parquet(path)


def test_daily_bars_need_one_shuffle_and_no_sort(candles):
    df = bars.daily_ohlcv(candles)
    text = plan(df)
    assert shuffles(df) == 1 and "Sort" not in text and "Window" not in text
    assert "partial_min_by" in text
    assert "number_of_trades" not in text  # never read


def test_latest_prices_need_one_shuffle(tables):
    df = bars.latest_prices(tables.staged_ticks())
    assert shuffles(df) == 1 and "Sort" not in plan(df)


@pytest.mark.parametrize("n", [1, 30])
def test_group_limits_run_before_the_shuffle(tables, n):
    df = dedup.first_rows(tables.ticks(), ["symbol"], [F.desc("event_time")], n)
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_silver_dedup_limits_before_the_shuffle(tables):
    df = silver.silver_ticks(tables.bronze(), dedup=True)
    assert plan(df).count("WindowGroupLimit") == 2 and shuffles(df) == 1


def test_quality_filters_reach_the_scan(candles):
    text = plan(silver.stg_historical(candles))
    assert "GreaterThan(open,0.0)" in text


def test_no_window_without_keys(tables):
    prices = bars.latest_prices(tables.staged_ticks())
    moods = mood.market_sentiment(tables.news_sentiment())
    text = plan(dashboard.dashboard_stats(prices, moods))
    assert "Subquery" in text
    for spec in re.findall(r"windowspecdefinition\(([^,]*),", text):
        assert "symbol" in spec
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_latest_day_is_a_pushed_subquery(spark, tables, candles, tmp_path):
    path = str(tmp_path / "daily")
    bars.daily_ohlcv(candles).write.parquet(path)
    text = plan(filters.latest_day(spark.read.parquet(path), "date"))
    assert "EqualTo(date,ScalarSubquery" in text


def test_high_water_mark_reaches_the_scan(spark, tables, candles):
    text = plan(incremental.new_rows(candles, candles.filter("symbol = 'CLICK'"), "open_time"))
    assert "GreaterThan(open_time,ScalarSubquery" in text


def test_today_reads_one_partition(spark, tables, tmp_path):
    path = str(tmp_path / "silver")
    ticks = silver.silver_ticks(tables.bronze(), parts=("year", "month", "day"))
    lake.write_partitioned(ticks, path, "overwrite", ("year", "month", "day"))
    stored = silver.stg_prices(spark.read.parquet(path))
    day = F.lit("2024-01-09").cast("date")
    text = plan(bars.intraday_ohlcv(stored, day))
    filters_ = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert all(f"{part}#" in filters_ for part in ("year", "month", "day"))


def test_alerts_join_one_row_per_symbol(tables, candles):
    summary = bars.daily_ohlcv(candles)
    df = accounts.evaluate_alerts(tables.alerts(), accounts.latest_closes(summary))
    text = plan(df)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "SortMergeJoin" in text or "BroadcastHashJoin" in text


def test_trailing_windows_scan_and_shuffle_once(spark, tables, tmp_path):
    path = str(tmp_path / "candles")
    tables.klines().select("symbol", "open_time", "close").write.parquet(path)
    stored = spark.read.parquet(path)
    short = plan(series.pct_changes(stored, "symbol", "open_time", ["close"]))
    assert short.count("Scan parquet") == 1 and short.count("Exchange hashpartitioning") == 1
    cut = series.pct_changes(stored, "symbol", "open_time", ["close"], block=100)
    text = plan(cut)
    # The rows once, and the list of split points.
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert len(scans) == 2 and sum("close#" in s for s in scans) == 1
    assert text.count("Exchange hashpartitioning") == 1
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", text)
    assert specs and all("_part" in s for s in specs)


def test_upsert_reads_only_the_touched_partitions(spark, tables, tmp_path):
    path = str(tmp_path / "t")
    rows = tables.ticks().withColumn("day", F.dayofmonth("event_time"))
    table = lake.LakeTable(spark, path, ["symbol", "event_time"], ["day"])
    table.overwrite(rows)
    few = rows.filter("day in (3, 4)")
    days = few.select("day").distinct()
    text = plan(table._inside(table.read(), days))
    assert "dynamicpruning" in text or "LeftSemi" in text


def test_newest_day_reports_read_their_input_once(spark, candles, tables, tmp_path):
    path = str(tmp_path / "daily")
    bars.daily_ohlcv(candles).write.parquet(path)
    daily = spark.read.parquet(path)
    for df in (
        dashboard.market_overview(daily, tables.coins()),
        dashboard.top_gainers(daily),
        dashboard.top_losers(daily),
        dashboard.distinct_coins(daily),
    ):
        assert plan(df).count("FileScan parquet") == 1


def test_per_key_values_are_joined_without_moving_the_rows(candles):
    df = series.relative_performance(candles, "symbol", "open_time", "close")
    assert "BroadcastHashJoin" in plan(df) and shuffles(df) == 0


def test_large_per_key_values_are_shuffled_not_broadcast(spark, candles):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64")
        df = series.relative_performance(candles, "symbol", "open_time", "close")
        assert "SortMergeJoin" in plan(df)
        assert df.count() == candles.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_each_message_is_parsed_once(spark, tables, tmp_path):
    path = str(tmp_path / "bronze")
    tables.bronze().write.parquet(path)
    bronze = spark.read.parquet(path)
    text = plan(silver.passing(silver.parse_ticks(bronze), silver.tick_rules()))
    assert text.count("from_json") == 1


def test_a_filter_on_scores_does_not_run_the_model_twice(spark, tables):
    from tickhouse.operators import scoring

    def factory():
        return lambda texts: [(0.5, "positive") for _ in texts]

    scored = scoring.score_sentiment(tables.news(), "title", factory)
    text = plan(silver.stg_news_sentiment(scored.withColumn("symbol", F.lit("A"))))
    assert text.count("ArrowEvalPython") == 1
