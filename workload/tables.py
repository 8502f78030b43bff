"""The driver's tables in the shape of market data.

Every function scans whole tables; nothing is sampled or cut. ``SQL`` holds the same views for
the oracle engine.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.functions import jsontext
from tickhouse.sources.lake import write_partitioned
from tickhouse.session import scratch_dir

SYMBOLS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")
COIN_ROWS = tuple((symbol, symbol.capitalize(), True) for symbol in SYMBOLS)
TOPIC = "crypto.prices"
# About 16 MB of JSON, which one task reads.
MESSAGES_PER_FILE = 150_000


def symbol_of(key: Column) -> Column:
    out = F.lit(SYMBOLS[4])
    for rest in (3, 2, 1, 0):
        out = F.when(key % 5 == rest, SYMBOLS[rest]).otherwise(out)
    return out


def files_per_batch(spark: SparkSession, path: str, batches: int) -> dict[str, str]:
    """The option by which a stream reads the files of a folder in so many batches, however many there are."""
    found = len(spark.read.parquet(path).inputFiles())
    return {"maxFilesPerTrigger": str(max(1, math.ceil(found / batches)))}


class Tables:
    """The adapted tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def ticks(self) -> DataFrame:
        return self.raw("events").select(
            "event_id",
            F.upper("event_type").alias("symbol"),
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").cast("double").alias("volume_24h"),
            F.col("ts").alias("event_time"),
            F.lit("events").alias("source"),
        )

    def staged_ticks(self) -> DataFrame:
        """Ticks in the staging shape: ``volume`` instead of ``volume_24h``."""
        return self.ticks().filter("price > 0").withColumnRenamed("volume_24h", "volume")

    def klines(self) -> DataFrame:
        hour = F.date_trunc("hour", "event_time").cast("timestamp_ntz")
        when = F.col("event_time")
        return (
            self.ticks()
            .groupBy("symbol", hour.alias("open_time"))
            .agg(
                F.min_by("price", when).alias("open"),
                F.max("price").alias("high"),
                F.min("price").alias("low"),
                F.max_by("price", when).alias("close"),
                F.sum("volume_24h").alias("volume"),
                F.count("*").alias("number_of_trades"),
            )
        )

    def news(self) -> DataFrame:
        hours = F.expr("make_dt_interval(0, cast(doc_id as int))")
        return self.raw("documents").select(
            F.col("doc_id").alias("article_id"),
            "source",
            F.substring_index("text", "\n", 1).alias("title"),
            F.col("text").alias("content"),
            "lang",
            (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + hours).alias("published_at"),
        )

    def news_sentiment(self) -> DataFrame:
        labels = self.raw("labels").withColumnRenamed("doc_id", "article_id")
        label = (
            F.when(F.col("toxic") == 1, "negative")
            .when(F.col("quality") == 1, "positive")
            .otherwise("neutral")
        )
        sign = F.when(F.col("toxic") == 1, -1.0).when(F.col("quality") == 1, 1.0).otherwise(0.0)
        strength = (50 + F.col("article_id") % 50).cast("double") / 100
        symbol = F.when(F.col("article_id") % 6 == 5, "Other").otherwise(
            symbol_of(F.col("article_id") % 6)
        )
        return (
            self.news()
            .join(labels, "article_id")
            .select(
                "article_id",
                "title",
                symbol.alias("symbol"),
                "published_at",
                "source",
                label.alias("sentiment_label"),
                (sign * strength).alias("sentiment_score"),
            )
        )

    def social(self) -> DataFrame:
        conv, turn = F.col("conv_id"), F.col("turn")
        return self.raw("conversations").select(
            F.col("role").alias("subreddit"),
            F.concat(conv.cast("string"), F.lit("-"), turn.cast("string")).alias("post_id"),
            F.lit(None).cast("string").alias("title"),
            "text",
            F.lit(0).alias("score"),
            F.lit(0).alias("num_comments"),
            (1704067200 + conv * 3600 + turn * 60).alias("created_utc"),
            F.lit(None).cast("string").alias("url"),
            F.lit("chat").alias("type"),
        )

    def alerts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("id"),
            F.col("c_nationkey").cast("bigint").alias("user_id"),
            symbol_of(key).alias("symbol"),
            F.when(key % 2 == 0, "above").otherwise("below").alias("condition"),
            (F.abs("c_acctbal") / 50).alias("threshold"),
            (key % 10 != 0).alias("is_active"),
        )

    def positions(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("id"),
            F.col("o_custkey").alias("user_id"),
            symbol_of(key).alias("symbol"),
            (1 + key % 7).alias("quantity"),
            (F.col("o_totalprice") / 1000).alias("avg_buy_price"),
        )

    def coins(self) -> DataFrame:
        return self.spark.createDataFrame(
            list(COIN_ROWS), "symbol string, name string, is_active boolean"
        )

    def as_of(self) -> Column:
        """The last day of the data, which stands in for today."""
        return self.raw("events").agg(F.max("ts").alias("t")).scalar().cast("date")

    # -- messages and files derived from the tables -----------------------------------

    def messages(self) -> DataFrame:
        """Every tick as a broker message."""
        tick = self.ticks().withColumn(
            "timestamp", F.unix_millis(F.col("event_time").cast("timestamp"))
        )
        payload = jsontext.encode("symbol", "price", "volume_24h", "timestamp", "source")
        return tick.select(
            F.encode("symbol", "UTF-8").alias("key"),
            F.encode(payload, "UTF-8").alias("value"),
            F.lit(TOPIC).alias("topic"),
            (F.col("event_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("event_time").cast("timestamp").alias("timestamp"),
        )

    def bronze(self) -> DataFrame:
        """Every tick as an envelope row."""
        return self.messages().select(
            F.col("key").cast("string").alias("kafka_key"),
            F.col("value").cast("string").alias("raw_value"),
            "topic",
            "partition",
            "offset",
            F.col("timestamp").alias("kafka_timestamp"),
            F.col("timestamp").alias("ingested_at"),
        )

    def message_source(self, parts: int = 3, backwards: bool = False) -> Mapping[str, str]:
        """The messages in ``parts`` parts by offset, streamed one by one, oldest or newest first.

        A part has as many files as its messages need. Those of one second share a file, so that no
        limit on the files of a batch separates copies of a tick in one part.
        """
        path = scratch_dir(self.spark, "messages")
        messages = self.messages()
        shares = [i / parts for i in range(1, parts)]
        found = messages.agg(
            F.count("*"), F.percentile_approx("offset", shares, 10000) if shares else F.lit(None)
        ).first()
        files = math.ceil(found[0] / parts / MESSAGES_PER_FILE) or 1
        later = [F.coalesce((F.col("offset") > cut).cast("int"), F.lit(0)) for cut in found[1] or []]
        part_of = sum(later, F.lit(0))
        for part in range(parts):  # One after the other, because streams take files by their age.
            (
                messages.filter(part_of == part)
                .repartition(files, F.date_trunc("second", "timestamp"))
                .sortWithinPartitions("offset")
                .write.mode("append").parquet(path)
            )
        limit = files_per_batch(self.spark, path, parts)
        return {"format": "parquet", "path": path, **limit, "latestFirst": str(backwards).lower()}

    def kline_dump(self, close: Column | None = None, opened: Column | None = None) -> str:
        """The candles as dump files of JSON arrays, in one folder per symbol.

        ``close`` replaces the closes and ``opened`` the text of the opening times.
        """
        path = scratch_dir(self.spark, "klines")
        k = self.klines()
        written = opened
        if close is not None:
            k = k.withColumn("close", close)
        opened = F.unix_millis(F.col("open_time").cast("timestamp"))
        texts = ("open", "high", "low", "close", "volume")
        items = [
            opened.cast("string") if written is None else written,
            *[F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in texts],
            (opened + 3599999).cast("string"),
            F.lit('"0"'),
            F.col("number_of_trades").cast("string"),
            F.lit('"0"'),
            F.lit('"0"'),
            F.lit('"0"'),
        ]
        row = F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("],"))
        write = k.select(row.alias("value"), "symbol")
        write_partitioned(write, path, "overwrite", ["symbol"], "text")
        return path


# The same views for the oracle engine, in dependency order.
_SYM = (
    "case {k} % 5 when 0 then 'CLICK' when 1 then 'ERROR' when 2 then 'PURCHASE' "
    "when 3 then 'SIGNUP' else 'VIEW' end"
)
SQL = {
    "ticks": (
        "select event_id, upper(event_type) as symbol, value as price, "
        "cast(json_extract_string(props, '$.k') as double) as volume_24h, "
        "ts as event_time, 'events' as source from events"
    ),
    "staged": (
        "select event_id, symbol, price, volume_24h as volume, event_time, source "
        "from ticks where price > 0"
    ),
    "clean": (
        "select event_id, symbol, price, volume_24h, date_trunc('milliseconds', event_time) "
        "as event_time, source from ticks where price > 0 and volume_24h > 0 "
        "qualify row_number() over (partition by symbol, date_trunc('milliseconds', event_time) "
        "order by event_time desc, event_id desc) = 1"
    ),
    "klines": (
        "select symbol, date_trunc('hour', event_time) as open_time, "
        "arg_min(price, event_time) as open, max(price) as high, min(price) as low, "
        "arg_max(price, event_time) as close, sum(volume_24h) as volume, "
        "count(*) as number_of_trades from ticks group by 1, 2"
    ),
    "daily": (
        "select symbol, open_time::date as date, arg_min(open, open_time) as open_price, "
        "max(high) as high_price, min(low) as low_price, arg_max(close, open_time) as close_price, "
        "sum(volume) as total_volume from klines where open > 0 group by 1, 2"
    ),
    "as_of": "select cast(max(ts) as date) as d from events",
    "today": (
        "select symbol, event_time::date as date, arg_min(price, event_time) as open_price, "
        "max(price) as high_price, min(price) as low_price, arg_max(price, event_time) as close_price, "
        "arg_max(volume, event_time) as total_volume from staged "
        "where event_time::date = (select d from as_of) group by 1, 2"
    ),
    "summary": (
        "select symbol, date, open_price, high_price, low_price, close_price, total_volume "
        "from daily where date < (select d from as_of) "
        "union select symbol, date, open_price, high_price, low_price, close_price, total_volume "
        "from today"
    ),
    "latest_prices": (
        "select symbol, price as latest_price, volume as latest_volume_24h, "
        "event_time as last_updated from staged "
        "qualify row_number() over (partition by symbol order by event_time desc) = 1"
    ),
    "news": (
        "select doc_id as article_id, source, split_part(text, chr(10), 1) as title, "
        "text as content, lang, timestamp '2024-01-01 00:00:00' + to_hours(cast(doc_id as int)) "
        "as published_at from documents"
    ),
    "news_sentiment": (
        "select article_id, title, case when article_id % 6 = 5 then 'Other' else "
        + _SYM.format(k="(article_id % 6)")
        + " end as symbol, published_at, source, "
        "case when toxic = 1 then 'negative' when quality = 1 then 'positive' else 'neutral' end "
        "as sentiment_label, "
        "(case when toxic = 1 then -1.0 when quality = 1 then 1.0 else 0.0 end)::double "
        "* ((50 + article_id % 50)::double / 100) as sentiment_score "
        "from news join labels on doc_id = article_id"
    ),
    "mood": (
        "select *, case when avg_sentiment_score > 0.2 then 'Bullish' when avg_sentiment_score < -0.2 "
        "then 'Bearish' else 'Neutral' end as market_mood from (select "
        "date_trunc('day', published_at)::timestamp as sentiment_date, symbol, "
        "avg(sentiment_score) as avg_sentiment_score, count(*) as total_articles, "
        "count(*) filter (sentiment_label = 'positive') as positive_count, "
        "count(*) filter (sentiment_label = 'negative') as negative_count, "
        "count(*) filter (sentiment_label = 'neutral') as neutral_count "
        "from news_sentiment where sentiment_score is not null group by 1, 2)"
    ),
    "social": (
        "select role as subreddit, conv_id::varchar || '-' || turn::varchar as post_id, "
        "cast(null as varchar) as title, text, 0 as score, 0 as num_comments, "
        "1704067200 + conv_id * 3600 + turn * 60 as created_utc, cast(null as varchar) as url, "
        "'chat' as type from conversations"
    ),
    "alerts": (
        "select c_custkey as id, cast(c_nationkey as bigint) as user_id, "
        + _SYM.format(k="c_custkey")
        + " as symbol, case when c_custkey % 2 = 0 then 'above' else 'below' end as condition, "
        "abs(c_acctbal) / 50 as threshold, c_custkey % 10 <> 0 as is_active from customer"
    ),
    "positions": (
        "select o_orderkey as id, o_custkey as user_id, "
        + _SYM.format(k="o_orderkey")
        + " as symbol, 1 + o_orderkey % 7 as quantity, o_totalprice / 1000 as avg_buy_price "
        "from orders"
    ),
    "coins": (
        "select * from (values "
        + ", ".join(f"('{s}', '{n}', true)" for s, n, _ in COIN_ROWS)
        + ") v(symbol, name, is_active)"
    ),
}


def with_views(body: str, *names: str) -> str:
    """``body`` with the named views, and those they need, in front of it."""
    needed = set(names)
    for name in reversed(list(SQL)):
        if name in needed:
            needed |= {
                other for other in SQL if other != name and _mentions(SQL[name], other)
            }
    views = [f"{name} as ({text})" for name, text in SQL.items() if name in needed]
    return f"with {', '.join(views)} {body}" if views else body


def _mentions(text: str, name: str) -> bool:
    return any(f"{word} {name}" in text for word in ("from", "join"))
