"""Sentiment roll-ups: daily market mood, overviews and their fallback chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import numeric, temporal
from tickhouse.operators.filters import latest_day

# The classes of a scorer, in report order.
LABELS = ("positive", "negative", "neutral")


def _class_counts(label: Column) -> list[Column]:
    return [F.count_if(label == name).alias(f"{name}_count") for name in LABELS]


def market_sentiment(sentiment: DataFrame) -> DataFrame:
    """Mean score, article and class counts, and mood per day and symbol."""
    scored = sentiment.filter(F.col("sentiment_score").isNotNull())
    daily = scored.groupBy(
        temporal.day_start(F.col("published_at")).alias("sentiment_date"), "symbol"
    ).agg(
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.count("*").alias("total_articles"),
        *_class_counts(F.col("sentiment_label")),
    )
    return daily.withColumn("market_mood", numeric.mood(F.col("avg_sentiment_score")))


def hourly_sentiment_counts(sentiment: DataFrame) -> DataFrame:
    """The earlier hourly form over all symbols."""
    return sentiment.groupBy(
        temporal.hour_start(F.col("published_at")).alias("sentiment_hour")
    ).agg(
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count("*").alias("article_count"),
        *_class_counts(F.col("sentiment_label"))[:2],
    )


def sentiment_momentum(sentiment: DataFrame) -> DataFrame:
    """Mean score per hour."""
    return sentiment.groupBy(temporal.hour_start(F.col("published_at")).alias("hour")).agg(
        F.avg("sentiment_score").alias("avg_sentiment")
    )


def label_distribution(sentiment: DataFrame) -> DataFrame:
    return sentiment.groupBy("sentiment_label").agg(F.count("*").alias("count"))


def symbol_label_counts(sentiment: DataFrame, pivoted: bool = False) -> DataFrame:
    """Articles per symbol and label; ``pivoted`` gives one column per class."""
    if pivoted:
        return sentiment.groupBy("symbol").agg(*_class_counts(F.col("sentiment_label")))
    return sentiment.groupBy("symbol", "sentiment_label").agg(F.count("*").alias("count"))


def _overview(totals: DataFrame) -> DataFrame:
    """Format (day, score, n, class counts) of one day; no row when there is no article."""
    counted = totals.filter(F.col("n") > 0)
    score = F.coalesce(F.col("score"), F.lit(0.0))
    percents = [
        F.round(F.coalesce(F.col(f"{name}_count"), F.lit(0)) / F.col("n") * 100, 2).alias(
            f"{name}_pct"
        )
        for name in LABELS
    ]
    return counted.select(
        F.round(score, 4).alias("overall_score"),
        numeric.mood(score).alias("overall_label"),
        *percents,
        F.col("n").cast("bigint").alias("article_count"),
        temporal.format_utc(F.col("day")).alias("last_updated"),
        F.lit(None).cast("string").alias("status"),
    )


def sentiment_overview(market: DataFrame) -> DataFrame:
    """The newest day over all symbols, each symbol weighted by its articles."""
    articles = F.sum("total_articles")
    weighted = F.sum(F.col("avg_sentiment_score") * F.col("total_articles"))
    totals = (
        latest_day(market, "sentiment_date")
        .groupBy(F.col("sentiment_date").alias("day"))
        .agg(
            F.when(articles > 0, weighted / articles)
            .otherwise(F.avg("avg_sentiment_score"))
            .alias("score"),
            articles.alias("n"),
            *[F.sum(f"{name}_count").alias(f"{name}_count") for name in LABELS],
        )
    )
    return _overview(totals)


def sentiment_overview_raw(sentiment: DataFrame) -> DataFrame:
    """The same from single scores, for when the daily table is not built yet."""
    scored = sentiment.filter(
        F.col("sentiment_score").isNotNull() & F.col("published_at").isNotNull()
    )
    newest = scored.agg(F.max("published_at").alias("newest")).scalar()
    # A bound on the raw column reaches the scan; a test on its date would not.
    last_day = scored.filter(F.col("published_at") >= F.date_trunc("day", newest))
    totals = last_day.groupBy(temporal.day_of(F.col("published_at")).alias("day")).agg(
        F.avg("sentiment_score").alias("score"),
        F.count("*").alias("n"),
        *_class_counts(F.lower("sentiment_label")),
    )
    return _overview(totals)


def neutral_overview(spark) -> DataFrame:
    """The one row shown while there is no sentiment at all."""
    return spark.range(1).select(
        F.lit(0.0).alias("overall_score"),
        F.lit("Neutral").alias("overall_label"),
        *[F.lit(0.0).alias(f"{name}_pct") for name in LABELS],
        F.lit(0).cast("bigint").alias("article_count"),
        F.lit(None).cast("string").alias("last_updated"),
        F.lit("sentiment_data_not_ready").alias("status"),
    )


def sentiment_overview_fallback(market: DataFrame, sentiment: DataFrame) -> DataFrame:
    """The first that has data: daily table, single scores, the neutral row."""
    choices = [
        sentiment_overview(market),
        sentiment_overview_raw(sentiment),
        neutral_overview(market.sparkSession),
    ]
    ranked = [df.withColumn("_priority", F.lit(i)) for i, df in enumerate(choices)]
    union = ranked[0].unionByName(ranked[1]).unionByName(ranked[2])
    return union.orderBy("_priority").limit(1).drop("_priority")


def high_impact_news(sentiment: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` articles with the strongest scores, in either direction."""
    return (
        sentiment.filter(F.col("sentiment_score").isNotNull())
        .orderBy(F.abs("sentiment_score").desc(), "published_at", "title")
        .limit(n)
        .select(
            "title",
            "sentiment_label",
            F.round("sentiment_score", 4).alias("score"),
            "published_at",
        )
    )
