"""The gold layer in dependency order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tickhouse.operators import bars, dashboard, mood, silver
from tickhouse.sources.lake import LakeTable

# Table -> unique key, in the order the tables depend on each other.
GOLD_KEYS = {
    "gold_daily_ohlcv": ("symbol", "date"),
    "gold_latest_prices": ("symbol",),
    "market_sentiment": ("sentiment_date", "symbol"),
    "daily_market_summary": ("symbol", "date"),
    "gold_dashboard_stats": ("symbol",),
}


def build_gold(
    prices: DataFrame,
    historical: DataFrame,
    sentiment: DataFrame,
    as_of: Column,
    normalize: bool = True,
    write_to: str | None = None,
) -> dict[str, DataFrame]:
    """All gold tables from the silver ones.

    With ``write_to`` each table is written below that folder and the tables depending on it
    read it from there; without, they are plans on the silver tables.
    """
    spark = prices.sparkSession

    def keep(name: str, df: DataFrame) -> DataFrame:
        if write_to is None:
            return df
        table = LakeTable(spark, f"{write_to}/{name}", GOLD_KEYS[name])
        table.overwrite(df)
        return table.read()

    ticks = silver.stg_prices(prices)
    candles = silver.stg_historical(historical)
    gold = {}
    gold["gold_daily_ohlcv"] = keep("gold_daily_ohlcv", bars.daily_ohlcv(candles))
    gold["gold_latest_prices"] = keep("gold_latest_prices", bars.latest_prices(ticks))
    gold["market_sentiment"] = keep(
        "market_sentiment", mood.market_sentiment(silver.stg_news_sentiment(sentiment))
    )
    gold["daily_market_summary"] = keep(
        "daily_market_summary", bars.market_summary(gold["gold_daily_ohlcv"], ticks, as_of)
    )
    gold["gold_dashboard_stats"] = keep(
        "gold_dashboard_stats",
        dashboard.dashboard_stats(
            gold["gold_latest_prices"], gold["market_sentiment"], normalize=normalize
        ),
    )
    return gold
