"""Values computed by hand from the seed formula."""

import pytest
from pyspark.sql import functions as F

from seed import seed_summary
from tickhouse import schemas
from tickhouse.operators import accounts, dashboard, mood


@pytest.fixture(scope="module")
def summary(spark):
    return seed_summary(spark).cache()


@pytest.fixture(scope="module")
def coins(spark):
    return schemas.coin_registry(spark)


def test_coin_summary(summary, coins):
    row = dashboard.coin_summary(summary, "btcusdt", coins).first()
    assert row.asDict() == {
        "symbol": "BTCUSDT", "trading_date": "2026-05-01", "day_open": 129.0, "day_close": 116.1,
        "day_high": 130.29, "day_low": 114.939, "total_volume": 10029.0, "avg_price": 122.55,
        "price_change_pct": -10.0, "tick_count": 0,
    }
    assert dashboard.coin_summary(summary, "NOPE", coins).collect() == []
    assert dashboard.coin_summary(summary).count() == 20


def test_coin_history(summary, coins):
    month = dashboard.coin_history(summary, "BTCUSDT", registry=coins).collect()
    week = dashboard.coin_history(summary, "ETHUSDT", 7, coins).collect()
    assert [len(month), len(week)] == [30, 7]
    stamps = [r["timestamp"] for r in month]
    assert stamps == sorted(stamps)
    assert stamps[-1] == "2026-05-01T00:00:00Z"
    assert [r["open"] for r in week] == [148.0 + i for i in range(7)]
    with pytest.raises(ValueError):
        dashboard.coin_history(summary, "BTCUSDT", 366)


def test_market_overview(summary, coins):
    row = dashboard.market_overview(summary, coins).first()
    assert row.asDict() == {
        "total_market_cap": 3293700.0, "total_volume_24h": 219580.0, "btc_dominance": 4.57,
        "active_coins": 20, "last_updated": "2026-05-01T00:00:00Z",
    }


def test_empty_overview(spark, coins):
    empty = spark.createDataFrame([], schemas.DAILY_BAR)
    row = dashboard.market_overview(empty, coins).first()
    assert (row.total_market_cap, row.total_volume_24h, row.btc_dominance) == (0.0, 0.0, 0.0)
    assert row.active_coins == 20 and row.last_updated is None
    assert dashboard.top_gainers(empty).collect() == []


def test_no_volume_gives_half_the_share(summary, coins):
    still = summary.withColumn("total_volume", F.lit(0.0))
    assert dashboard.market_overview(still, coins).first().btc_dominance == 50.0


def test_movers(summary, coins):
    def listed(df):
        return [(r["symbol"][:-4], r["change_pct"]) for r in df.collect()]

    assert listed(dashboard.top_gainers(summary, registry=coins)) == [
        ("FIL", 9.0), ("ICP", 8.0), ("VET", 7.0), ("ALGO", 6.0), ("XLM", 5.0)
    ]
    assert listed(dashboard.top_losers(summary, registry=coins)) == [
        ("ADA", -6.0), ("XRP", -7.0), ("BNB", -8.0), ("ETH", -9.0), ("BTC", -10.0)
    ]
    report = dashboard.market_report(summary, coins).first()
    assert [c["name"] for c in report.top_gainers][:2] == ["Filecoin", "Internet Computer"]
    assert [c["symbol"] for c in report.top_losers][-1] == "BTCUSDT"


@pytest.mark.parametrize("n", [0, 4, 5, 6])
def test_movers_with_few_coins(summary, n):
    some = summary.filter(F.col("symbol").isin([s for s, _ in schemas.COINS[:n]]))
    gain = [r["symbol"] for r in dashboard.top_gainers(some).collect()]
    lose = [r["symbol"] for r in dashboard.top_losers(some).collect()]
    ranking = [s for s, _ in reversed(schemas.COINS[:n])]
    assert gain == ranking[:5] and lose == ranking[-5:]


def test_names_of_unregistered_symbols(spark, coins):
    df = spark.createDataFrame([("BTCUSDT",), ("NEWUSDT",), ("ODD",)], "symbol string")
    named = {r["symbol"]: r["name"] for r in dashboard.coin_names(df, coins).collect()}
    assert named == {"BTCUSDT": "Bitcoin", "NEWUSDT": "NEW", "ODD": "ODD"}


def test_coin_table_pages(summary, coins):
    day = dashboard.coin_names(summary.filter("date = '2026-05-01'"), coins)
    page = dashboard.coin_table(day, "", ["total_volume desc"], 1, 10).collect()
    assert [r["symbol"] for r in page] == [s for s, _ in reversed(schemas.COINS[:10])]
    assert dashboard.coin_table(day, "COIN", ["symbol"]).count() == 4


def test_dashboard_joins_pairs_with_coins(spark):
    prices = spark.createDataFrame(
        [("BTCUSDT", 60000.0, 5.0, None), ("DOGEUSDT", 0.1, 2.0, None)], schemas.LATEST_PRICES
    )
    moods = spark.sql(
        "select timestamp'2026-05-01' as sentiment_date, * from values "
        "('BTC', 0.5, 'Bullish'), ('Other', 0.0, 'Neutral') t(symbol, avg_sentiment_score, market_mood)"
    )
    plain = dashboard.dashboard_stats(prices, moods)
    assert plain.count() == 4  # neither name matches the other
    joined = {r.symbol: r for r in dashboard.dashboard_stats(prices, moods, normalize=True).collect()}
    assert set(joined) == {"BTC", "DOGE", "Other"}
    assert joined["BTC"].market_mood == "Bullish" and joined["BTC"].latest_price == 60000.0
    assert joined["DOGE"].market_mood is None and joined["Other"].latest_price is None
    assert {r.active_coins for r in joined.values()} == {1}


def test_mood_at_the_threshold_is_neutral(spark):
    df = spark.sql(
        "select timestamp'2026-05-01 10:00:00' as published_at, * from values "
        "('A', 0.2D, 'positive'), ('B', 0.21D, 'positive'), ('C', -0.2D, 'negative'), "
        "('D', -0.21D, 'negative'), ('E', null, 'positive') t(symbol, sentiment_score, sentiment_label)"
    )
    got = {r.symbol: r.market_mood for r in mood.market_sentiment(df).collect()}
    assert got == {"A": "Neutral", "B": "Bullish", "C": "Neutral", "D": "Bearish"}


def test_sentiment_fallback_chain(spark):
    empty_gold = spark.createDataFrame([], schemas.MARKET_SENTIMENT)
    empty_raw = spark.createDataFrame([], schemas.NEWS_SENTIMENT)
    neutral = mood.sentiment_overview_fallback(empty_gold, empty_raw).first()
    assert neutral.status == "sentiment_data_not_ready" and neutral.article_count == 0
    raw = spark.sql(
        "select timestamp'2026-05-01 10:00:00' as published_at, * from values "
        "(0.5D, 'Positive'), (0.1D, 'neutral') t(sentiment_score, sentiment_label) union all "
        "select timestamp'2026-04-01 10:00:00', -1D, 'negative'"
    )
    second = mood.sentiment_overview_fallback(empty_gold, raw).first()
    assert (second.overall_score, second.overall_label) == (0.3, "Bullish")
    assert (second.positive_pct, second.negative_pct, second.article_count) == (50.0, 0.0, 2)
    gold = spark.sql(
        "select timestamp'2026-05-02' as sentiment_date, * from values "
        "('A', 1.0D, 3L, 3L, 0L, 0L), ('B', -1.0D, 1L, 0L, 1L, 0L) t(symbol, avg_sentiment_score, "
        "total_articles, positive_count, negative_count, neutral_count)"
    )
    first = mood.sentiment_overview_fallback(gold, raw).first()
    assert (first.overall_score, first.article_count) == (0.5, 4)
    assert (first.positive_pct, first.last_updated) == (75.0, "2026-05-02T00:00:00Z")


def test_alerts_fire_at_exactly_the_threshold(spark, summary):
    close = 129.0 * 0.9
    alerts = spark.createDataFrame(
        [
            (1, 1, "btcusdt", "above", close, True),
            (2, 1, "BTCUSDT", "below", close, True),
            (3, 1, "BTCUSDT", "above", 116.2, True),
            (4, 1, "BTCUSDT", "below", 116.0, True),
            (5, 1, "BTCUSDT", "above", 1.0, False),
            (6, 1, "UNKNOWN", "above", 1.0, True),
            (7, 1, "BTCUSDT", "near", 1.0, True),
        ],
        "id long, user_id long, symbol string, condition string, threshold double, is_active boolean",
    )
    fired = accounts.evaluate_alerts(alerts, accounts.latest_closes(summary))
    assert sorted(r.id for r in fired.collect()) == [1, 2]
    message = fired.filter("id = 1").select(accounts.alert_message().alias("m")).first().m
    assert message == (
        f"ALERT TRIGGERED: alert_id=1 user_id=1 BTCUSDT is above {close} (current: {close})"
    )
    after = {r.id: r.is_active for r in accounts.deactivate_alerts(alerts, fired).collect()}
    assert after == {1: False, 2: False, 3: True, 4: True, 5: False, 6: True, 7: True}
