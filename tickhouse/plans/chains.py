"""End-to-end chains over a lake folder: candles, prices, news and posts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse import schemas
from tickhouse.functions import temporal
from tickhouse.operators import bars, dashboard, dedup, mood, quality, silver
from tickhouse.operators.scoring import article_key, enrich_news, lexicon_sentiment
from tickhouse.plans.increments import refresh_bars
from tickhouse.session import settle
from tickhouse.sources.files import SYMBOL_IN_PATH, read_kline_files
from tickhouse.sources.lake import LakeTable, read_lake, read_lake_stream
from tickhouse.sources.messages import parse_payload
from tickhouse.streaming import ticks as streams


# What a chain does with each finished table besides keeping it, such as a JDBC append:
# ``lambda name, df: jdbc_incremental_append(df, url, name, "open_time", props)``.
Publish = Callable[[str, DataFrame], object]


def keep_only(name: str, df: DataFrame) -> None:
    """Publish nowhere."""


@dataclass(frozen=True)
class Lake:
    """Where the chains keep their tables."""

    spark: SparkSession
    root: str
    tick_parts: tuple[str, ...] = ("year", "month", "day", "hour")
    candle_parts: tuple[str, ...] = ("symbol", "year", "month")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"

    def table(
        self, layer: str, name: str, partition_by=None, order_by=(), schema=None
    ) -> LakeTable:
        spec = schemas.CATALOG[f"{layer}.{name}"]
        parts = spec.partition_by if partition_by is None else partition_by
        return LakeTable(self.spark, self.path(layer, name), spec.keys, parts, order_by, schema)

    def bronze_candles(self) -> LakeTable:
        # Declared, because a symbol made of digits would be read back as a number.
        schema = schemas.HISTORICAL + "".join(
            f", {part} int" for part in self.candle_parts if part != "symbol"
        )
        newest = [F.desc("ingested_at")]
        return self.table("bronze", "historical", self.candle_parts, newest, schema)

    def silver_prices(self) -> LakeTable:
        newest = [F.desc_nulls_last(c) for c in ("ingested_at", "kafka_timestamp", "offset")]
        return self.table("silver", "prices", self.tick_parts, newest)


def load_candles(
    lake: Lake,
    dump: str,
    symbol_pattern: str = SYMBOL_IN_PATH,
    as_of: Column | None = None,
    publish: Publish = keep_only,
) -> dict[str, DataFrame]:
    """Candle dumps to bronze (upsert), clean rows to silver, then the daily bars.

    With ``as_of`` also the market summary of that day, with today's bar from the lake's ticks,
    and the quality report over both. A dump that is loaded again changes nothing, and candles
    that cannot be placed (no symbol or no time) are not loaded; ``out["rejected"]`` has them with
    their reason, and ``out["recomputed"]`` the days whose bars were computed again.

    Each layer is brought up to date by what differs from the layer below, not by what this load
    added, so corrected candles reach silver and gold, and a load that a crash cut short is
    made up for by the next one. Silver takes only candles of the dump's time range; bars are
    computed again only for days whose candles have another digest than before.
    """
    bronze = lake.bronze_candles()
    dumped = settle(read_kline_files(lake.spark, dump, symbol_pattern), "dump")
    calendar = tuple(part for part in lake.candle_parts if part != "symbol")
    # A dump repeats its symbol's whole history; only what is new or corrected is written.
    values = [name for name in dumped.columns if name not in ("symbol", "open_time", "ingested_at")]
    rejected = bronze.upsert(temporal.with_parts(dumped, "open_time", calendar), compare=values)

    stored = lake.table("silver", "historical")
    span = dumped.agg(F.min("open_time").alias("low"), F.max("open_time").alias("high"))
    rows = bronze.read()
    if stored.exists():
        low, high = span.select("low").scalar(), span.select("high").scalar()
        rows = temporal.since_year(rows, low).filter(F.col("open_time").between(low, high))
    clean = dedup.dedup_keys(
        silver.silver_klines(rows), ["symbol", "open_time"], [F.desc("ingested_at")]
    )
    stored.upsert(clean, compare=values)
    stored.compact()

    daily = lake.table("gold", "gold_daily_ohlcv")
    recomputed = refresh_bars(
        stored,
        daily,
        lake.table("gold", "daily_bar_digests"),
        lake.table("gold", "candle_file_stamps"),
    )
    publish("silver.historical", stored.read())
    out = {
        "silver.historical": stored.read(),
        "gold_daily_ohlcv": daily.read(),
        "rejected": rejected,
        "recomputed": recomputed,
    }
    if as_of is not None:
        prices = lake.silver_prices()
        ticks = prices.read() if prices.exists() else _empty(lake, schemas.PRICES)
        summary = lake.table("gold", "daily_market_summary")
        summary.overwrite(bars.market_summary(daily.read(), silver.stg_prices(ticks), as_of))
        out["daily_market_summary"] = summary.read()
        out["report"] = check_gold(
            {name: out[name] for name in ("gold_daily_ohlcv", "daily_market_summary")}
        )
    return out


def _empty(lake: Lake, schema: str) -> DataFrame:
    return lake.spark.createDataFrame([], schema)


def load_prices(
    lake: Lake,
    source: Mapping[str, str],
    as_of: Column,
    topic: str = "crypto.prices",
    trigger: streams.Trigger = streams.CATCH_UP,
    publish: Publish = keep_only,
    files_per_batch: int = 1000,
) -> dict[str, DataFrame]:
    """Messages to bronze, bronze to silver, then newest prices and the market summary.

    The summary's history are the lake's daily bars, as far as candles were loaded. Both streams run
    until they have caught up; with another trigger they are started by ``bronze_stream`` and
    ``silver_stream`` directly and the gold part runs on its own. ``files_per_batch`` bounds what
    one batch of a backlog reads; the message source has its own limit in ``source``.
    """
    bronze_path = lake.path("bronze", "prices")
    streams.bronze_stream(
        lake.spark, source, bronze_path, lake.checkpoint("bronze_prices"), topic,
        starting="earliest", trigger=trigger,
    ).awaitTermination()
    table = lake.silver_prices()
    newest = lake.table("gold", "gold_latest_prices")
    streams.silver_stream(
        read_lake_stream(
            lake.spark, bronze_path, schemas.ENVELOPE, {"maxFilesPerTrigger": str(files_per_batch)}
        ),
        table, lake.checkpoint("silver_prices"), trigger, parts=lake.tick_parts, latest=newest,
    ).awaitTermination()

    publish("silver.prices", table.read())
    ticks = silver.stg_prices(table.read())
    bars_table = lake.table("gold", "gold_daily_ohlcv")
    daily = bars_table.read() if bars_table.exists() else _empty(lake, schemas.DAILY_BAR)
    summary = lake.table("gold", "daily_market_summary")
    summary.overwrite(bars.market_summary(daily, ticks, as_of))
    return {"gold_latest_prices": newest.read(), "daily_market_summary": summary.read()}


def load_news(
    lake: Lake,
    messages: DataFrame,
    scorer: Callable[[DataFrame], DataFrame] | None = None,
    latest_prices: DataFrame | None = None,
    publish: Publish = keep_only,
) -> dict[str, DataFrame]:
    """News messages to silver, scored and tagged, then daily mood and dashboard rows.

    Articles are stored once by url and title, however often a feed sends them, and only those
    that have no score yet are scored.
    """
    parsed = parse_payload(messages, schemas.NEWS_PAYLOAD, keep=("ingested_at",))
    news = lake.table("silver", "news")
    clean = settle(silver.silver_news(parsed, ("url", "title")), "news")
    if news.exists():
        held = news.read().select("url", "title").alias("h")
        same = [F.col(f"h.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("url", "title")]
        clean = settle(clean.alias("c").join(held, same, "left_anti"), "new-news")
    if not news.exists() or not clean.isEmpty():
        news.append(clean)
    rate = scorer or (lambda df: lexicon_sentiment(df, "title"))
    scored = lake.table("silver", "news_sentiment")
    unscored = news.read()
    if scored.exists():
        keyed = unscored.withColumn("article_id", article_key(unscored))
        unscored = settle(
            keyed.join(scored.read().select("article_id"), "article_id", "left_anti"), "unscored"
        )
    # Written before it is used twice, so that no text is scored twice.
    if not scored.exists() or not unscored.isEmpty():
        scored.append(settle(enrich_news(unscored, rate), "scored"))
    publish("silver.news", news.read())
    publish("silver.news_sentiment", scored.read())
    market = lake.table("gold", "market_sentiment")
    market.overwrite(mood.market_sentiment(silver.stg_news_sentiment(scored.read())))
    out = {"news_sentiment": scored.read(), "market_sentiment": market.read()}
    if latest_prices is not None:
        stats = lake.table("gold", "gold_dashboard_stats")
        stats.overwrite(
            dashboard.dashboard_stats(latest_prices, market.read(), normalize=True)
        )
        out["gold_dashboard_stats"] = stats.read()
    return out


def load_social(lake: Lake, messages: DataFrame, publish: Publish = keep_only) -> DataFrame:
    """Post messages to silver, one row per post however often the feed re-sent it.

    Posts of earlier loads stay; one that comes again with another content replaces the stored one.
    Posts without an id cannot be told apart and are not stored.
    """
    parsed = parse_payload(messages, schemas.SOCIAL_PAYLOAD, keep=("ingested_at",))
    table = lake.table("silver", "social")
    posts = silver.silver_social(parsed, ("post_id",))
    table.upsert(posts, compare=[c for c in posts.columns if c not in ("post_id", "ingested_at")])
    publish("silver.social", table.read())
    return table.read()


def check_gold(gold: Mapping[str, DataFrame]) -> DataFrame:
    """The quality report over the gold tables that were built."""
    return quality.run_assertions(gold, quality.gold_rules())


def read_gold(lake: Lake, name: str) -> DataFrame:
    return read_lake(lake.spark, lake.path("gold", name))
