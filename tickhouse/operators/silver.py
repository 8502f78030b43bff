"""Silver layer: typed rows that pass the quality rules, staging views, and the rejects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse import schemas
from tickhouse.functions import temporal
from tickhouse.operators.dedup import dedup_keys
from tickhouse.sources.messages import parse_payload

# Newest arrival first; messages of one arrival time by their position in the stream.
NEWEST_ARRIVAL = (F.desc_nulls_last, ("ingested_at", "kafka_timestamp", "offset"))


def tick_rules() -> dict[str, Column]:
    """Reject reason -> what a tick must satisfy. A null volume fails ``volume_24h > 0``."""
    return {
        "symbol_missing": F.col("symbol").isNotNull(),
        "price_missing": F.col("price").isNotNull(),
        "event_time_missing": F.col("event_time").isNotNull(),
        "price_not_positive": F.col("price") > 0,
        "volume_not_positive": F.col("volume_24h") > 0,
    }


def kline_rules() -> dict[str, Column]:
    return {
        "open_not_positive": F.col("open") > 0,
        "symbol_missing": F.col("symbol").isNotNull(),
    }


def news_rules() -> dict[str, Column]:
    return {"title_missing": F.col("title").isNotNull()}


def social_rules() -> dict[str, Column]:
    return {"title_and_text_missing": F.col("title").isNotNull() | F.col("text").isNotNull()}


def passing(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    for rule in rules.values():
        df = df.filter(rule)
    return df


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows ``passing`` leaves out, with the first rule each one fails."""
    reason = F.lit(None).cast("string")
    for name, rule in reversed(rules.items()):
        # A rule that is null on a row (null volume) is not satisfied.
        reason = F.when(F.coalesce(rule, F.lit(False)), reason).otherwise(name)
    return df.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())


def parse_ticks(bronze: DataFrame, truncate_to: str | None = None) -> DataFrame:
    """Envelope rows to typed tick columns, unfiltered."""
    keep = [c for c in ("kafka_timestamp", "ingested_at", "offset") if c in bronze.columns]
    parsed = parse_payload(bronze, schemas.TICK_PAYLOAD, keep=keep)
    return parsed.select(
        "symbol",
        "price",
        "volume_24h",
        "source",
        temporal.epoch_millis(F.col("timestamp"), truncate_to).alias("event_time"),
        *keep,
    )


def arrival_order(df: DataFrame) -> list[Column]:
    """Newest arrival first, by whichever arrival columns the frame has."""
    direction, names = NEWEST_ARRIVAL
    return [direction(name) for name in names if name in df.columns]


def silver_ticks(
    bronze: DataFrame,
    truncate_to: str | None = None,
    dedup: bool = False,
    parts: tuple[str, ...] = ("year", "month", "day", "hour"),
) -> DataFrame:
    """Parsed ticks that pass the quality rules, with their calendar partition columns."""
    ticks = passing(parse_ticks(bronze, truncate_to), tick_rules())
    if dedup:
        ticks = dedup_keys(ticks, ["symbol", "event_time"], arrival_order(ticks))
    return temporal.with_parts(
        ticks.withColumn("processed_at", F.current_timestamp()), "event_time", parts
    )


def silver_klines(bronze: DataFrame) -> DataFrame:
    """Candles with a positive open and a symbol, with calendar columns."""
    return temporal.with_parts(
        passing(bronze, kline_rules()).withColumn("processed_at", F.current_timestamp()),
        "open_time",
        ("year", "month", "day"),
    )


def silver_news(bronze: DataFrame, dedup_keys_: tuple[str, ...] = ()) -> DataFrame:
    """News columns with a real publication time; articles without a title are left out."""
    news = passing(bronze, news_rules()).select(
        "source",
        "title",
        "description",
        "url",
        temporal.iso_timestamp(F.col("published_at")).alias("published_at"),
        "content",
        "ingested_at",
    )
    return dedup_keys(news, dedup_keys_, arrival_order(news)) if dedup_keys_ else news


def silver_social(bronze: DataFrame, dedup_keys_: tuple[str, ...] = ()) -> DataFrame:
    """Posts that have a title or a text; feeds re-send posts, so ``post_id`` can dedup them."""
    posts = passing(bronze, social_rules()).select(
        "subreddit",
        "post_id",
        "title",
        "text",
        "score",
        "num_comments",
        "created_utc",
        temporal.epoch_seconds(F.col("created_utc")).alias("created_at"),
        "url",
        "type",
        "ingested_at",
    )
    return dedup_keys(posts, dedup_keys_, arrival_order(posts)) if dedup_keys_ else posts


# -- staging views ---------------------------------------------------------------------


def stg_prices(prices: DataFrame) -> DataFrame:
    wanted = ("source", "processed_at", "year", "month", "day")
    extra = [c for c in wanted if c in prices.columns]
    return prices.filter(F.col("price") > 0).select(
        "symbol", "price", F.col("volume_24h").alias("volume"), "event_time", *extra
    )


def stg_historical(hist: DataFrame) -> DataFrame:
    wanted = (
        "symbol", "open_time", "open", "high", "low", "close", "volume",
        "year", "month", "day", "processed_at",
    )
    return hist.filter(F.col("open") > 0).select(*[c for c in wanted if c in hist.columns])


def stg_news(news: DataFrame) -> DataFrame:
    wanted = (
        "title", "source", "description", "published_at", "url", "content", "ingested_at",
    )
    return news.filter(F.col("title").isNotNull()).select(
        *[c for c in wanted if c in news.columns]
    )


def stg_social(social: DataFrame) -> DataFrame:
    wanted = (
        "subreddit", "post_id", "title", "text", "score", "num_comments", "created_at", "url",
        "type", "ingested_at",
    )
    return passing(social, social_rules()).select(*[c for c in wanted if c in social.columns])


def stg_news_sentiment(sentiment: DataFrame) -> DataFrame:
    wanted = (
        "article_id", "symbol", "sentiment_score", "sentiment_label", "published_at",
        "ingested_at",
    )
    return sentiment.filter(F.col("sentiment_score").isNotNull()).select(
        *[c for c in wanted if c in sentiment.columns]
    )
