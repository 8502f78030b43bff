"""The end-to-end chains on small dumps and messages."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickhouse import schemas
from tickhouse.operators import bars, digests, silver
from tickhouse.plans import chains, gold, increments

DAY = 86_400_000
START = 1_767_225_600_000  # 2026-01-01


def dump(folder, symbol, hours, close=2.0):
    folder.mkdir(exist_ok=True)
    data = [
        [START + h * 3_600_000, "1.0", "3.0", "0.5", str(close), "10", START + h * 3_600_000 + 1,
         "0", 1, "0", "0", "0"]
        for h in hours
    ]
    (folder / f"{symbol}_raw_klines.json").write_text(json.dumps(data))


def test_a_symbol_filled_in_late_gets_its_bars(spark, tmp_path):
    store, source = chains.Lake(spark, str(tmp_path / "lake")), tmp_path / "dump"
    dump(source, "btcusdt", range(72))
    dump(source, "ethusdt", range(10))
    chains.load_candles(store, str(source))
    dump(source, "ethusdt", range(36))  # older than the newest candle of the other symbol
    dump(source, "solusdt", range(5))
    out = chains.load_candles(store, str(source))
    assert out["silver.historical"].count() == 72 + 36 + 5
    got = {(r.symbol, r.date): r.total_volume for r in out["gold_daily_ohlcv"].collect()}
    assert got == {
        ("BTCUSDT", date(2026, 1, 1)): 240.0, ("BTCUSDT", date(2026, 1, 2)): 240.0,
        ("BTCUSDT", date(2026, 1, 3)): 240.0, ("ETHUSDT", date(2026, 1, 1)): 240.0,
        ("ETHUSDT", date(2026, 1, 2)): 120.0, ("SOLUSDT", date(2026, 1, 1)): 50.0,
    }
    before = rows(out["gold_daily_ohlcv"])
    published = {}
    again = chains.load_candles(
        store, str(source), as_of=F.lit("2026-01-03").cast("date"),
        publish=lambda name, df: published.update({name: df.count()}),
    )
    assert rows(again["gold_daily_ohlcv"]) == before
    assert published == {"silver.historical": 113}
    assert again["daily_market_summary"].count() == 5  # the last day waits for its ticks
    assert again["report"].filter("not passed").count() == 0


def test_corrections_and_crashes_reach_gold(spark, tmp_path, monkeypatch):
    store, source = chains.Lake(spark, str(tmp_path / "lake")), tmp_path / "dump"
    dump(source, "btcusdt", range(30))
    chains.load_candles(store, str(source))
    # The driver dies between silver and gold.
    dump(source, "btcusdt", range(40))
    with monkeypatch.context() as crash:
        crash.setattr(chains.bars, "daily_ohlcv", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            chains.load_candles(store, str(source))
    dump(source, "btcusdt", range(40), close=2.5)
    out = chains.load_candles(store, str(source))
    got = {r.date: (r.close_price, r.total_volume) for r in out["gold_daily_ohlcv"].collect()}
    assert got == {date(2026, 1, 1): (2.5, 240.0), date(2026, 1, 2): (2.5, 160.0)}
    assert out["silver.historical"].count() == 40


def test_only_changed_days_are_recomputed(spark, tmp_path):
    store, source = chains.Lake(spark, str(tmp_path / "lake")), tmp_path / "dump"
    days = lambda out: sorted((r.symbol, r.date.day, r.gone) for r in out["recomputed"].collect())
    dump(source, "btcusdt", range(72))
    dump(source, "ethusdt", range(30))
    assert len(days(chains.load_candles(store, str(source)))) == 5
    assert days(chains.load_candles(store, str(source))) == []  # a repeat
    dump(source, "btcusdt", range(73))  # one candle more
    assert days(chains.load_candles(store, str(source))) == [("BTCUSDT", 4, False)]
    # One candle is corrected, and one day taken out.
    stored = store.table("silver", "historical")
    hour = F.hour("open_time") + 24 * (F.dayofmonth("open_time") - 1)
    rows_ = stored.read().filter("not (symbol = 'ETHUSDT' and day(open_time) = 2)")
    high = F.when((hour == 30) & (F.col("symbol") == "BTCUSDT"), 9.0).otherwise(F.col("high"))
    stored.overwrite(rows_.withColumn("high", high))
    tables = [store.table("gold", n) for n in ("gold_daily_ohlcv", "daily_bar_digests", "candle_file_stamps")]
    changed = increments.refresh_bars(stored, *tables)
    assert days({"recomputed": changed}) == [("BTCUSDT", 2, False), ("ETHUSDT", 2, True)]
    wanted = bars.daily_ohlcv(silver.stg_historical(stored.read())).select(*bars.BAR)
    assert rows(tables[0].read().select(*bars.BAR)) == rows(wanted)
    assert increments.refresh_bars(stored, *tables).count() == 0
    keys = tables[0].read().groupBy("symbol", "date").count()
    assert keys.filter("count > 1").count() == 0


def test_digests_are_of_multisets(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), ("c", None)], "k string, v int")
    of = lambda d: digests.group_digests(d, ["k"], ["v"])
    differ = lambda x, y: rows(digests.changed_groups(of(x), of(y), ["k"]))
    assert differ(df, df.orderBy(F.desc("v")).repartition(3)) == []
    assert differ(df, df.distinct()) == [("b", False)]
    assert differ(df, df.filter("k <> 'c'")) == [("c", True)]
    assert differ(df.limit(0), df) == [("a", False), ("b", False), ("c", False)]
    assert differ(df, df.fillna(0)) == [("c", False)]


def test_later_posts_leave_earlier_ones(spark, tmp_path):
    store = chains.Lake(spark, str(tmp_path / "lake"))
    post = lambda i, text: (json.dumps({"post_id": i, "text": text, "created_utc": 1767225600}),)
    load = lambda *posts: chains.load_social(
        store, spark.createDataFrame(list(posts), "raw_value string").withColumn("ingested_at", F.current_timestamp())
    )
    load(post("a", "one"))
    load(post("b", "two"), post(None, "nobody"))
    got = load(post("b", "three"), post("a", "one"))
    assert rows(got.select("post_id", "text")) == [("a", "one"), ("b", "three")]


def test_bad_rows_are_listed_and_reloading_changes_nothing(spark, tmp_path):
    store, source = chains.Lake(spark, str(tmp_path / "lake")), tmp_path / "dump"
    dump(source, "btcusdt", range(3))
    path = source / "btcusdt_raw_klines.json"
    path.write_text(path.read_text().replace(str(START + 3_600_000), '"soon"', 1))
    counts = set()
    for _ in range(3):
        out = chains.load_candles(store, str(source))
        assert [r.reject_reason for r in out["rejected"].collect()] == ["open_time_null"]
        counts.add((store.bronze_candles().read().count(), out["silver.historical"].count()))
    assert counts == {(2, 2)}


def test_known_articles_are_not_scored_again(spark, tmp_path):
    store, asked = chains.Lake(spark, str(tmp_path)), []

    def messages(*names):
        sent = [{"source": "s", "title": f"bull {n}", "url": n, "published_at": "2026-01-01T10:00:00Z"} for n in names]
        df = spark.createDataFrame([(json.dumps(a),) for a in sent], "raw_value string")
        return df.withColumn("ingested_at", F.current_timestamp())

    def scorer(df):
        asked.append(sorted(r.url for r in df.select("url").collect()))
        return chains.lexicon_sentiment(df, "title")

    chains.load_news(store, messages("a", "b"), scorer)
    chains.load_news(store, messages("a", "b"), scorer)
    out = chains.load_news(store, messages("b", "c"), scorer)
    assert asked == [["a", "b"], ["c"]]
    assert out["news_sentiment"].count() == 3
    assert out["market_sentiment"].first().total_articles == 3


def test_news_to_dashboard(spark, tmp_path):
    store = chains.Lake(spark, str(tmp_path))
    articles = [
        {"source": "s", "title": "Bitcoin bull run", "url": "a", "published_at": "2026-01-01T10:00:00Z"},
        {"source": "s", "title": "Bitcoin bull run", "url": "a", "published_at": "2026-01-01T10:00:00Z"},
        {"source": "s", "title": "A crash of ripple", "url": "b", "published_at": "2026-01-01T11:00:00Z"},
        {"source": "s", "title": None, "url": "c", "published_at": "2026-01-01T11:00:00Z"},
    ]
    sent = spark.createDataFrame([(json.dumps(a),) for a in articles], "raw_value string")
    prices = spark.createDataFrame([("BTCUSDT", 9.0, 1.0, None)], schemas.LATEST_PRICES)
    out = chains.load_news(
        store, sent.withColumn("ingested_at", F.current_timestamp()), latest_prices=prices
    )
    assert {(r.symbol, r.sentiment_score) for r in out["news_sentiment"].collect()} == {
        ("BTC", 1.0), ("XRP", -1.0)
    }
    stats = {r.symbol: (r.latest_price, r.market_mood) for r in out["gold_dashboard_stats"].collect()}
    assert stats == {"BTC": (9.0, "Bullish"), "XRP": (None, "Bearish")}


def test_gold_report_flags_the_outer_join(spark):
    prices = spark.sql(
        "select 'BTCUSDT' as symbol, 5.0D as price, 1.0D as volume_24h, "
        "timestamp'2026-01-02 10:00:00' as event_time"
    )
    hist = spark.sql(
        "select 'BTCUSDT' as symbol, timestamp'2026-01-01 10:00:00' as open_time, 1.0D as open, "
        "1.0D as high, 2.0D as low, 1.0D as close, 0.0D as volume"
    )
    scored = spark.sql(
        "select '1' as article_id, 'Other' as symbol, 0.9D as sentiment_score, 'positive' as "
        "sentiment_label, timestamp'2026-01-01 10:00:00' as published_at"
    )
    tables = gold.build_gold(prices, hist, scored, F.lit("2026-01-02").cast("date"))
    assert tables["daily_market_summary"].count() == 2
    failed = {
        (r.rule, r.table): r.failing_rows
        for r in chains.check_gold(tables).filter("not passed").collect()
    }
    assert failed == {
        ("low_le_high", "daily_market_summary"): 1,
        ("volume_positive", "daily_market_summary"): 1,
        ("not_null_latest_price", "gold_dashboard_stats"): 1,
        ("not_null_last_updated", "gold_dashboard_stats"): 1,
    }
    assert silver.stg_historical(hist).count() == 1
