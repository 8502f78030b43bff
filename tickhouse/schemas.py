"""Declared schemas (DDL text) of every message and table; nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

# Field names, types and key columns that the feeds and tables agree on.

ENVELOPE = (
    "kafka_key string, raw_value string, topic string, partition int, offset bigint, "
    "kafka_timestamp timestamp, ingested_at timestamp"
)
TICK_PAYLOAD = "symbol string, price double, volume_24h double, timestamp bigint, source string"
MARKET_PAYLOAD = (
    "symbol string, name string, price double, market_cap double, market_cap_rank int, "
    "total_volume double, price_change_percentage_24h double, timestamp bigint, source string"
)
NEWS_PAYLOAD = (
    "source string, author string, title string, description string, url string, "
    "published_at string, content string, timestamp bigint"
)
SOCIAL_PAYLOAD = (
    "subreddit string, post_id string, title string, text string, score int, "
    "num_comments int, created_utc bigint, url string, timestamp bigint, type string"
)
KLINE_FIELDS = (
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume", "ignore",
)
HISTORICAL = (
    "open_time timestamp, open double, high double, low double, close double, volume double, "
    "close_time timestamp, quote_asset_volume double, number_of_trades bigint, "
    "taker_buy_base_asset_volume double, taker_buy_quote_asset_volume double, "
    "symbol string, ingested_at timestamp"
)
PRICES = (
    "symbol string, price double, volume_24h double, source string, event_time timestamp, "
    "kafka_timestamp timestamp, ingested_at timestamp, processed_at timestamp, "
    "year int, month int, day int, hour int"
)
NEWS = (
    "source string, title string, description string, url string, published_at timestamp, "
    "content string, ingested_at timestamp"
)
SOCIAL = (
    "subreddit string, post_id string, title string, text string, score int, num_comments int, "
    "created_utc bigint, created_at timestamp, url string, type string, ingested_at timestamp"
)
NEWS_SENTIMENT = (
    "article_id string, title string, symbol string, published_at timestamp, "
    "sentiment_score double, sentiment_label string, source string, ingested_at timestamp"
)
DAILY_BAR = (
    "symbol string, date date, open_price double, high_price double, low_price double, "
    "close_price double, total_volume double"
)
LATEST_PRICES = (
    "symbol string, latest_price double, latest_volume_24h double, last_updated timestamp"
)
DIGEST = "n bigint, low_1 bigint, high_1 bigint, low_2 bigint, high_2 bigint"
MARKET_SENTIMENT = (
    "sentiment_date timestamp, symbol string, avg_sentiment_score double, total_articles bigint, "
    "positive_count bigint, negative_count bigint, neutral_count bigint, market_mood string"
)
DASHBOARD_STATS = (
    "symbol string, latest_price double, latest_volume_24h double, last_updated timestamp, "
    "avg_sentiment_score double, market_mood string, last_sentiment_update timestamp, "
    "active_coins bigint"
)
ALERTS = (
    "id bigint, user_id bigint, symbol string, condition string, threshold decimal(18,8), "
    "is_active boolean"
)
PORTFOLIOS = (
    "id bigint, user_id bigint, symbol string, quantity decimal(18,8), avg_buy_price decimal(18,8)"
)
WATCHLISTS = "id bigint, user_id bigint, symbol string, added_at timestamp"

# The registered coins, in registry order, with their display names.
COINS = (
    ("BTCUSDT", "Bitcoin"), ("ETHUSDT", "Ethereum"), ("BNBUSDT", "BNB"), ("XRPUSDT", "XRP"),
    ("ADAUSDT", "Cardano"), ("SOLUSDT", "Solana"), ("DOTUSDT", "Polkadot"),
    ("DOGEUSDT", "Dogecoin"), ("MATICUSDT", "Polygon"), ("LINKUSDT", "Chainlink"),
    ("AVAXUSDT", "Avalanche"), ("UNIUSDT", "Uniswap"), ("ATOMUSDT", "Cosmos"),
    ("LTCUSDT", "Litecoin"), ("ETCUSDT", "Ethereum Classic"), ("XLMUSDT", "Stellar"),
    ("ALGOUSDT", "Algorand"), ("VETUSDT", "VeChain"), ("ICPUSDT", "Internet Computer"),
    ("FILUSDT", "Filecoin"),
)


@dataclass(frozen=True)
class TableSpec:
    """What the catalog declares about one table."""

    layer: str
    ddl: str
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()


CATALOG = {
    "bronze.messages": TableSpec("bronze", ENVELOPE),
    "bronze.historical": TableSpec("bronze", HISTORICAL, ("symbol", "open_time"), ("symbol",)),
    "silver.prices": TableSpec(
        "silver", PRICES, ("symbol", "event_time"), ("year", "month", "day", "hour")
    ),
    "silver.historical": TableSpec(
        "silver",
        HISTORICAL + ", year int, month int, day int, processed_at timestamp",
        ("symbol", "open_time"),
        ("year",),
    ),
    "silver.news": TableSpec("silver", NEWS),
    "silver.social": TableSpec("silver", SOCIAL, ("post_id",)),
    "silver.news_sentiment": TableSpec("silver", NEWS_SENTIMENT, ("article_id",)),
    "gold.gold_daily_ohlcv": TableSpec("gold", DAILY_BAR, ("symbol", "date")),
    "gold.daily_bar_digests": TableSpec("gold", f"symbol string, date date, {DIGEST}", ("symbol", "date")),
    "gold.candle_file_stamps": TableSpec("gold", f"year int, {DIGEST}", ("year",)),
    "gold.daily_market_summary": TableSpec("gold", DAILY_BAR, ("symbol", "date")),
    "gold.gold_latest_prices": TableSpec("gold", LATEST_PRICES, ("symbol",)),
    "gold.market_sentiment": TableSpec("gold", MARKET_SENTIMENT, ("sentiment_date", "symbol")),
    "gold.gold_dashboard_stats": TableSpec("gold", DASHBOARD_STATS, ("symbol",)),
    "app.alerts": TableSpec("app", ALERTS, ("id",)),
    "app.portfolios": TableSpec("app", PORTFOLIOS, ("id",)),
    "app.watchlists": TableSpec("app", WATCHLISTS, ("id",)),
}


def coin_registry(spark):
    """The registered coins as a table of 20 rows (symbol, name, is_active)."""
    rows = [(symbol, name, True) for symbol, name in COINS]
    return spark.createDataFrame(rows, "symbol string, name string, is_active boolean")
