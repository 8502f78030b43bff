"""Sources, sinks, scalar functions, streams and end-to-end chains."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tickhouse import schemas
from tickhouse.functions import jsontext, numeric, temporal, text
from tickhouse.operators import accounts, quality, scoring, silver
from tickhouse.plans import chains, gold, increments
from tickhouse.session import scratch_dir
from tickhouse.sources import files, lake, messages
from tickhouse.streaming import alerts
from tickhouse.streaming import late as late_ticks
from tickhouse.streaming import ticks as streams
from workload import batch
from workload.registry import query
from workload.tables import TOPIC, Tables, files_per_batch

CATCH_UP = {"availableNow": True}
DAYS = ("year", "month", "day")
# Payload in a file of a feed, which one task writes.
FEED_FILE_BYTES = 16 << 20


def finished(q):
    q.awaitTermination()
    return q


def landed(t: Tables):
    """The messages after they were streamed into a bronze folder; returns its path."""
    path, checkpoint = scratch_dir(t.spark, "bronze"), scratch_dir(t.spark, "checkpoint")
    finished(
        streams.bronze_stream(
            t.spark, t.message_source(), path, checkpoint, TOPIC, "earliest", CATCH_UP
        )
    )
    return path


def bronze_rows(t: Tables):
    """The landed messages as a stream of three batches."""
    path = landed(t)
    return lake.read_lake_stream(t.spark, path, schemas.ENVELOPE, files_per_batch(t.spark, path, 3))


def silver_table(t: Tables, parts=DAYS) -> lake.LakeTable:
    newest = [F.desc_nulls_last(c) for c in ("ingested_at", "kafka_timestamp", "offset")]
    path = scratch_dir(t.spark, "silver")
    return lake.LakeTable(t.spark, path, ["symbol", "event_time"], parts, newest)


ENVELOPES = (
    "select symbol as kafka_key, 'crypto.prices' as topic, (event_id % 4)::int as partition, "
    "event_id as offset, event_time as kafka_timestamp, symbol as said_symbol, price as said_price, "
    "volume_24h as said_volume, epoch_us(event_time) // 1000 as said_time, source as said_source from ticks"
)


def with_payload(envelopes):
    """Envelopes with the fields of their unparsed payload instead of its text."""
    def said(field, kind="string"):
        return F.get_json_object("raw_value", f"$.{field}").cast(kind)

    return envelopes.withColumns(
        {
            "said_symbol": said("symbol"),
            "said_price": said("price", "double"),
            "said_volume": said("volume_24h", "double"),
            "said_time": said("timestamp", "bigint"),
            "said_source": said("source"),
        }
    ).drop("raw_value", "ingested_at")


# -- sources and sinks -----------------------------------------------------------------


@query(
    "s1_read_message_stream",
    "select symbol as key, 'crypto.prices' as topic, (event_id % 4)::int as partition, "
    "event_id as offset, event_time as timestamp from ticks",
    "ticks",
)
def _(t):
    stream = messages.read_message_stream(t.spark, t.message_source(), TOPIC, "earliest")
    path = scratch_dir(t.spark, "read")
    finished(lake.append_stream(stream, path, scratch_dir(t.spark, "checkpoint"), CATCH_UP))
    return t.spark.read.parquet(path).select(
        F.col("key").cast("string").alias("key"), "topic", "partition", "offset", "timestamp"
    )


def read_from(t: Tables, source, starting, path: str, name: str):
    """Catch up with the messages of ``source``; ``name`` keeps the checkpoint and the positions."""
    stream = messages.read_message_stream(t.spark, source, TOPIC, starting, positions=f"{name}-positions")
    finished(lake.append_stream(stream, path, name, CATCH_UP))
    return t.spark.read.schema(messages.RAW_MESSAGE).parquet(path).select("partition", "offset")


def stored_messages(t: Tables, where: str, path: str) -> dict[str, str]:
    """Messages written behind those that ``path`` has."""
    t.messages().filter(where).write.mode("append").parquet(path)
    return {"format": "parquet", "path": path}


def last_offset(t: Tables) -> int:
    return t.messages().agg(F.max("offset")).first()[0]


@query(
    "s1_start_latest",
    "select (event_id % 4)::int as partition, event_id as offset from ticks "
    "where event_id >= (select max(event_id) // 2 from ticks)",
    "ticks",
)
def _(t):
    """Half of the messages are stored before the stream starts; the rest come in two parts."""
    path, out, name = (scratch_dir(t.spark, n) for n in ("messages", "read", "checkpoint"))
    half = last_offset(t) // 2
    source = stored_messages(t, f"offset < {half}", path)
    read_from(t, source, "latest", out, name)
    for part in (f"offset between {half} and {half + half // 2}", f"offset > {half + half // 2}"):
        stored_messages(t, part, path)
        rows = read_from(t, source, "latest", out, name)
    return rows


@query(
    "s1_start_offsets",
    "select (event_id % 4)::int as partition, event_id as offset from ticks, (select max(event_id) // 2 as "
    "half from ticks) where case event_id % 4 when 0 then true when 1 then event_id >= half // 2 "
    "else event_id >= half end",
    "ticks",
)
def _(t):
    """Positions per partition: all, from an offset, from now on, from an offset that comes later."""
    path, out, name = (scratch_dir(t.spark, n) for n in ("messages", "read", "checkpoint"))
    half = last_offset(t) // 2
    starting = {0: messages.EARLIEST, 1: half // 2, 2: messages.LATEST, 3: half}
    source = stored_messages(t, f"offset < {half} and partition <> 3", path)
    read_from(t, source, starting, out, name)
    stored_messages(t, f"offset >= {half} or partition = 3", path)
    return read_from(t, source, starting, out, name)


@query(
    "s1_offset_gaps",
    "select topic, partition, prev as after, event_id as before, (event_id - prev) // 4 - 1 as missing "
    "from (select 'crypto.prices' as topic, (event_id % 4)::int as partition, event_id, "
    "lag(event_id) over (partition by event_id % 4 order by event_id) as prev "
    "from ticks where event_id % 7 <> 0) where event_id - prev > 4",
    "ticks",
)
def _(t):
    """Every seventh message is missing."""
    return messages.offset_gaps(t.messages().filter("offset % 7 <> 0"), step=4, slice_size=500)


@query(
    "s2_bronze_envelope",
    ENVELOPES,
    "ticks",
)
def _(t):
    return with_payload(messages.bronze_envelope(t.messages()))


@query(
    "s3_parse_payload",
    "select symbol, price, volume_24h, epoch_us(event_time) // 1000 as timestamp, source, "
    "event_id as offset from ticks",
    "ticks",
)
def _(t):
    return messages.parse_payload(t.bronze(), schemas.TICK_PAYLOAD, keep=["offset"])


@query(
    "s4_read_kline_files",
    "select symbol, open_time, open, high, low, close, volume, "
    "open_time + interval 3599999 millisecond as close_time, number_of_trades from klines",
    "klines",
)
def _(t):
    rows = files.read_kline_files(t.spark, t.kline_dump(), r"symbol=([^/]+)/")
    return rows.select(
        "symbol", "open_time", "open", "high", "low", "close", "volume", "close_time",
        "number_of_trades",
    )


@query(
    "s5_read_articles",
    "select source, lang as author, title, article_id::varchar as url, published_at, content "
    "from news",
    "news",
)
def _(t):
    # One backup file per poll of at most 100 articles, each one JSON array.
    path = scratch_dir(t.spark, "articles")
    article = F.struct(
        F.struct(F.lit(None).cast("string").alias("id"), F.col("source").alias("name")).alias(
            "source"
        ),
        F.col("lang").alias("author"),
        "title",
        F.col("article_id").cast("string").alias("url"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        "content",
    )
    polls = (
        t.news()
        .groupBy(F.expr("article_id div 100").alias("poll"))
        .agg(F.to_json(F.collect_list(article)).alias("value"))
    )
    lake.write_partitioned(polls, path, "overwrite", ["poll"], "text")
    return files.read_articles(t.spark, path).drop("description")


@query("s6_read_lake", "select event_id, ts, user_id, event_type, value, props from events")
def _(t):
    return lake.read_lake(
        t.spark, f"{t.sf_dir}/events.parquet",
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    )


@query("s7_read_lake_stream", "select symbol as kafka_key, event_id as offset from ticks", "ticks")
def _(t):
    path = scratch_dir(t.spark, "copy")
    stream = bronze_rows(t).select("kafka_key", "offset")
    finished(lake.append_stream(stream, path, scratch_dir(t.spark, "checkpoint"), CATCH_UP))
    return t.spark.read.parquet(path)


@query(
    "s8_append_stream",
    "select symbol, price, event_time from (select symbol, price, "
    "date_trunc('milliseconds', event_time) as event_time from ticks)",
    "ticks",
)
def _(t):
    path = scratch_dir(t.spark, "ticks")
    stream = silver.parse_ticks(bronze_rows(t)).select("symbol", "price", "event_time")
    finished(
        lake.append_stream(
            stream, path, scratch_dir(t.spark, "checkpoint"), CATCH_UP,
            partition_by=["symbol"],
        )
    )
    return t.spark.read.parquet(path)


@query(
    "s9_write_partitioned",
    "select symbol, open_time, close, year(open_time)::int as year, month(open_time)::int "
    "as month, day(open_time)::int as day from klines",
    "klines",
)
def _(t):
    path = scratch_dir(t.spark, "partitioned")
    rows = t.klines().select("symbol", "open_time", "close")
    lake.write_partitioned(
        temporal.with_parts(rows, "open_time", DAYS), path, "overwrite", DAYS
    )
    return lake.read_lake(t.spark, path)


@query(
    "s14_export_csv",
    "select symbol as \"Coin\", price::varchar as \"Price\", event_time::date::varchar as \"Day\" "
    "from ticks",
    "ticks",
)
def _(t):
    path = scratch_dir(t.spark, "csv")
    rows = t.ticks().withColumn("day", F.to_date("event_time"))
    files.export_csv(rows, path, {"symbol": "Coin", "price": "Price", "day": "Day"})
    return t.spark.read.option("header", True).option("escape", '"').schema(
        "Coin string, Price string, Day string"
    ).csv(path)


@query(
    "s14_export_odd_values",
    "select event_id::varchar as \"Id\", coalesce(case when event_id % 3 <> 0 then 'say \"' || symbol || "
    "'\",' || chr(10) || 'x' end, '') as \"Said\", '{\"v\":' || (event_id % 5) || '}' as \"Nested\" "
    "from ticks",
    "ticks",
)
def _(t):
    """Nulls, quotes, commas, line feeds and nested values survive the CSV."""
    path = scratch_dir(t.spark, "csv")
    said = F.concat(F.lit('say "'), F.col("symbol"), F.lit('",\nx'))
    rows = t.ticks().select(
        "event_id", F.when(F.col("event_id") % 3 != 0, said).alias("said"),
        F.struct((F.col("event_id") % 5).alias("v")).alias("nested"),
    )
    files.export_csv(rows, path, {"event_id": "Id", "said": "Said", "nested": "Nested"})
    back = t.spark.read.options(header=True, escape='"', multiLine=True, emptyValue="").schema(
        "Id string, Said string, Nested string"
    ).csv(path)
    return back.withColumn("Said", F.coalesce("Said", F.lit("")))


@query(
    "s14_export_json",
    "select title as \"Title\", published_at as \"Published\", source as \"Source\" from news",
    "news",
)
def _(t):
    path = scratch_dir(t.spark, "json")
    files.export_json(
        t.news(), path, {"title": "Title", "published_at": "Published", "source": "Source"}
    )
    return t.spark.read.schema(
        "Title string, Published timestamp_ntz, Source string"
    ).json(path)


@query(
    "s15_compact",
    "select event_id, symbol, price, event_time::date as day, 2 as files from ticks",
    "ticks",
)
def _(t):
    path = scratch_dir(t.spark, "loose")
    rows = t.ticks().select("event_id", "symbol", "price", F.to_date("event_time").alias("day"))
    # Every one of six tasks leaves a file in every day; one remains after the merge.
    rows.repartition(6, "event_id").write.partitionBy("day").parquet(path)
    lake.compact(t.spark, path, ["day"])
    per_day = t.spark.read.parquet(path)
    count = F.col("_metadata.file_path")
    most = per_day.groupBy("day").agg(F.count_distinct(count).alias("n")).agg(
        (F.max("n") + 1).cast("int").alias("n")
    )
    return per_day.withColumn("files", most.scalar())


@query(
    "s16_ticker_payload",
    "select symbol, price, volume_24h, epoch_us(event_time) // 1000 as timestamp, 'binance' as source "
    "from (select symbol, case when symbol = 'ERROR' then 0 else price end as price, volume_24h, "
    "event_time from ticks)",
    "ticks",
)
def _(t):
    raw = t.ticks().select(
        jsontext.encode(
            F.col("symbol").alias("s"),
            F.when(F.col("symbol") != "ERROR", F.col("price").cast("string")).alias("c"),
            F.col("volume_24h").cast("string").alias("v"),
            F.unix_millis(F.col("event_time").cast("timestamp")).alias("E"),
        ).alias("raw_value")
    )
    return messages.normalize_payload(raw, "ticker")


@query(
    "s16_market_payload",
    "select symbol, 'coin ' || symbol as name, close as price, "
    "close * 1000 as market_cap, number_of_trades::int as market_cap_rank, volume as total_volume, "
    "high - low as price_change_percentage_24h, epoch_ms(open_time) as timestamp, "
    "'coingecko' as source from klines",
    "klines",
)
def _(t):
    raw = t.klines().select(
        jsontext.encode(
            "symbol",
            F.concat(F.lit("coin "), F.col("symbol")).alias("name"),
            F.col("close").alias("current_price"),
            (F.col("close") * 1000).alias("market_cap"),
            F.col("number_of_trades").alias("market_cap_rank"),
            F.col("volume").alias("total_volume"),
            (F.col("high") - F.col("low")).alias("price_change_percentage_24h"),
        ).alias("raw_value"),
        F.col("open_time").cast("timestamp").alias("arrived"),
    )
    return messages.normalize_payload(raw, "market", arrived_at=F.col("arrived"))


@query(
    "s16_article_payload",
    "select source, lang as author, title, cast(null as varchar) as description, "
    "article_id::varchar as url, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') as published_at, "
    "content, epoch_ms(published_at) as timestamp from news",
    "news",
)
def _(t):
    raw = t.news().select(
        jsontext.encode(
            F.struct(F.col("source").alias("name")).alias("source"),
            F.col("lang").alias("author"),
            "title",
            F.col("article_id").cast("string").alias("url"),
            F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            "content",
        ).alias("raw_value"),
        F.col("published_at").cast("timestamp").alias("arrived"),
    )
    return messages.normalize_payload(raw, "article", arrived_at=F.col("arrived"))


@query(
    "s16_feed_payload",
    "select subreddit, case when subreddit = 'user' then 'https://posts/' || post_id else post_id end "
    "as post_id, '' as title, text, 0 as score, 0 as num_comments, created_utc, "
    "'https://posts/' || post_id as url, created_utc * 1000 as timestamp, 'rss_opinion' as type "
    "from social",
    "social",
)
def _(t):
    link = F.concat(F.lit("https://posts/"), F.col("post_id"))
    raw = t.social().select(
        jsontext.encode(
            F.col("subreddit").alias("feed"),
            F.when(F.col("subreddit") != "user", F.col("post_id")).alias("id"),
            F.col("text").alias("summary"),
            link.alias("link"),
        ).alias("raw_value"),
        F.timestamp_seconds("created_utc").alias("arrived"),
    )
    return messages.normalize_payload(raw, "feed", arrived_at=F.col("arrived"))


@query(
    "u2_union_files",
    "select symbol, open_time, close from klines",
    "klines",
)
def _(t):
    rows = t.klines().select("symbol", "open_time", "close")
    is_early = F.col("open_time") < F.expr("timestamp_ntz'2024-01-16'")
    paths = []
    for part in (rows.filter(is_early), rows.filter(~is_early)):
        paths.append(scratch_dir(t.spark, "part"))
        part.write.parquet(paths[-1])
    return files.union_files(
        t.spark, paths, "symbol string, open_time timestamp_ntz, close double"
    )


@query(
    "j2_merge_upsert",
    "select symbol, event_time, case when event_time >= timestamp '2024-01-10 12:00:00' "
    "then price + 1000 else price end as price from ticks",
    "ticks",
)
def _(t):
    rows = temporal.with_parts(
        t.ticks().select("event_id", "symbol", "event_time", "price"), "event_time", DAYS
    )
    table = lake.LakeTable(
        t.spark, scratch_dir(t.spark, "upsert"), ["symbol", "event_time"], DAYS
    )
    # The first load ends on the 20th; the second one replaces what it has from the noon of the
    # 10th on, in the middle of a partition, and adds the rest.
    first = F.col("event_time") < F.expr("timestamp_ntz'2024-01-20'")
    second = F.col("event_time") >= F.expr("timestamp_ntz'2024-01-10 12:00:00'")
    table.upsert(rows.filter(first))
    table.upsert(rows.filter(second).withColumn("price", F.col("price") + 1000))
    return table.read().select("symbol", "event_time", "price")


@query(
    "j2_null_partition",
    "select event_id, case when event_id % 7 = 0 then 'day_null' when event_id % 5 = 0 then "
    "'symbol_null' end as reject_reason from ticks",
    "ticks",
)
def _(t):
    """Rows without a key or partition come back with their reason; all others are stored once."""
    rows = t.ticks().select(
        "event_id",
        F.when((F.col("event_id") % 5 != 0) | (F.col("event_id") % 7 == 0), F.col("symbol")).alias("symbol"),
        F.when(F.col("event_id") % 7 != 0, F.dayofmonth("event_time")).alias("day"),
    )
    table = lake.LakeTable(t.spark, scratch_dir(t.spark, "upsert"), ["event_id", "symbol"], ["day"])
    for _load in (1, 2):
        rejected = table.upsert(rows)
    return (
        table.read().select("event_id", F.lit(None).cast("string").alias("reject_reason"))
        .unionByName(rejected.select("event_id", "reject_reason"))
    )


# -- scalar functions ------------------------------------------------------------------


@query(
    "x1_epoch_millis",
    "select event_id, date_trunc('milliseconds', event_time) as exact, "
    "date_trunc('second', event_time) as seconds from ticks",
    "ticks",
)
def _(t):
    ms = F.unix_millis(F.col("event_time").cast("timestamp"))
    return t.ticks().select(
        "event_id", temporal.epoch_millis(ms).alias("exact"),
        temporal.epoch_millis(ms, "second").alias("seconds"),
    )


@query(
    "x2_epoch_seconds",
    "select post_id, make_timestamp(created_utc * 1000000) as created_at from social",
    "social",
)
def _(t):
    return t.social().select(
        "post_id", temporal.epoch_seconds(F.col("created_utc")).alias("created_at")
    )


@query(
    "x3_iso_timestamp",
    "select article_id, case when lang = 'de' then null else published_at end as parsed "
    "from news",
    "news",
)
def _(t):
    stamp = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    odd = F.date_format("published_at", "dd.MM.yyyy HH:mm")
    given = F.when(F.col("lang") == "de", odd).otherwise(stamp)
    return t.news().select("article_id", temporal.iso_timestamp(given).alias("parsed"))


@query(
    "x4_calendar_parts",
    "select event_id, year(event_time)::int as year, month(event_time)::int as month, "
    "day(event_time)::int as day, hour(event_time)::int as hour from ticks",
    "ticks",
)
def _(t):
    rows = temporal.with_parts(t.ticks(), "event_time", (*DAYS, "hour"))
    return rows.select("event_id", *DAYS, "hour")


@query(
    "x5_truncation",
    "select event_id, event_time::date as day, date_trunc('day', event_time)::timestamp as start, "
    "date_trunc('hour', event_time)::timestamp as hour, event_time::date = (select d from as_of) "
    "as is_today from ticks",
    "ticks as_of",
)
def _(t):
    when = F.col("event_time")
    return t.ticks().select(
        "event_id", temporal.day_of(when).alias("day"), temporal.day_start(when).alias("start"),
        temporal.hour_start(when).alias("hour"),
        (temporal.day_of(when) == t.as_of()).alias("is_today"),
    )


@query(
    "x6_text_functions",
    "select c_custkey, lower(c_name) as low, upper(c_mktsegment) as up, "
    "contains(c_name, '77') as has, replace(c_name, 'Customer', 'C') as short, "
    "split_part(c_name, '#', 2) as number, substring(c_name, 1, 10) as head, "
    "regexp_replace(upper(c_mktsegment || 'usdt'), 'USDT$', '') as coin from customer",
)
def _(t):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return t.raw("customer").select(
        "c_custkey", F.lower(name).alias("low"), F.upper(segment).alias("up"),
        name.contains("77").alias("has"),
        F.replace(name, F.lit("Customer"), F.lit("C")).alias("short"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("number"),
        F.substring(name, 1, 10).alias("head"),
        text.normalize_symbol(F.concat(segment, F.lit("usdt"))).alias("coin"),
    )


@query(
    "x7_words",
    "select doc_id, len(w)::int as words, w[1] as first, w[len(w)] as last from (select doc_id, "
    "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as w from documents)",
)
def _(t):
    w = F.col("w")
    return t.raw("documents").select("doc_id", text.words(F.col("text")).alias("w")).select(
        "doc_id", F.size(w).alias("words"), F.get(w, F.lit(0)).alias("first"),
        F.get(w, F.size(w) - 1).alias("last"),
    )


@query(
    "x8_numbers",
    "select c_custkey, abs(c_acctbal) as size, round(c_acctbal / 7, 4) as seventh, "
    "c_acctbal::varchar::double as parsed, case when c_mktsegment <> 'MACHINERY' then c_custkey end "
    "as whole from customer",
)
def _(t):
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    broken = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_name")).otherwise(
        key.cast("string")
    )
    return t.raw("customer").select(
        "c_custkey", F.abs(balance).alias("size"), F.round(balance / 7, 4).alias("seventh"),
        numeric.to_double(balance.cast("string")).alias("parsed"),
        numeric.to_long(broken).alias("whole"),
    )


@query(
    "x9_case_coalesce",
    "select article_id, case sentiment_label when 'positive' then abs(sentiment_score) when 'negative' "
    "then -abs(sentiment_score) else 0 end as signed, case when abs(sentiment_score) > 0.75 "
    "then 'Bullish' when abs(sentiment_score) < 0.35 then 'Bearish' else 'Neutral' end as class "
    "from news_sentiment",
    "news_sentiment",
)
def _(t):
    """The library's own CASE expressions: signed scores and mood classes."""
    strength = F.abs("sentiment_score")
    return t.news_sentiment().select(
        "article_id",
        scoring.signed_score(strength, F.col("sentiment_label")).alias("signed"),
        numeric.mood(strength - 0.55).alias("class"),
    )


@query(
    "x10_pct_change",
    "select symbol, open_time, round(case when open > 0 then (close - open) / open * 100 "
    "else 0 end, 6) as change_pct from klines",
    "klines",
)
def _(t):
    change = numeric.pct_change(F.col("open"), F.col("close"))
    return t.klines().select("symbol", "open_time", F.round(change, 6).alias("change_pct"))


# Words of the test texts, so that every rule of the tagger is reached.
RULES = (("A", ("the", "que")), ("B", ("und", "der")), ("C", ("con", "re")))


def _rule_sql(test):
    return (
        "case "
        + " ".join(
            f"when {' or '.join(test(word) for word in words)} then '{name}'"
            for name, words in RULES
        )
        + " else 'Other' end"
    )


@query(
    "x11_symbol_from_title",
    "select article_id, "
    + _rule_sql(lambda word: f"contains(lower(title), '{word}')")
    + " as by_substring, "
    + _rule_sql(
        lambda word: f"list_contains(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]+'), '{word}')"
    )
    + " as by_word from news",
    "news",
)
def _(t):
    title = F.col("title")
    return t.news().select(
        "article_id", text.symbol_from_title(title, RULES).alias("by_substring"),
        text.symbol_from_title(title, RULES, "word").alias("by_word"),
    )


@query(
    "x12_json",
    "select event_id, symbol, price, volume_24h, cast(null as varchar) as note from ticks",
    "ticks",
)
def _(t):
    packed = jsontext.encode(
        "event_id", "symbol", "price", "volume_24h", F.lit(None).cast("string").alias("note")
    )
    schema = "event_id bigint, symbol string, price double, volume_24h double, note string"
    return t.ticks().select(jsontext.decode(packed, schema).alias("p")).select("p.*")


@query(
    "x13_formats",
    "select article_id, strftime(published_at, '%Y-%m-%d') as day, "
    "strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') as utc from news",
    "news",
)
def _(t):
    when = F.col("published_at")
    return t.news().select(
        "article_id", temporal.format_date(when).alias("day"), temporal.format_utc(when).alias("utc")
    )


@query(
    "x14_mood",
    "select article_id, case when sentiment_score / 4 > 0.2 then 'Bullish' "
    "when sentiment_score / 4 < -0.2 then 'Bearish' else 'Neutral' end as mood "
    "from news_sentiment",
    "news_sentiment",
)
def _(t):
    return t.news_sentiment().select(
        "article_id", numeric.mood(F.col("sentiment_score") / 4).alias("mood")
    )


# -- streams ---------------------------------------------------------------------------


@query(
    "r1_bronze_stream",
    ENVELOPES,
    "ticks",
)
def _(t):
    return with_payload(lake.read_lake(t.spark, landed(t), schemas.ENVELOPE))


CLEAN = "select symbol, price, volume_24h, event_time from clean"


@query("r2_silver_stream", CLEAN, "clean")
def _(t):
    table = silver_table(t)
    finished(
        streams.silver_stream(
            bronze_rows(t), table, scratch_dir(t.spark, "checkpoint"), CATCH_UP, parts=DAYS
        )
    )
    return table.read().select("symbol", "price", "volume_24h", "event_time")


@query(
    "r3_stream_dedup",
    "select distinct symbol, date_trunc('milliseconds', event_time) as event_time from ticks",
    "ticks",
)
def _(t):
    sent = t.messages()
    path = scratch_dir(t.spark, "twice")
    # Every message is delivered twice, the copy at another offset.
    sent.unionByName(sent.withColumn("offset", F.col("offset") + 10_000_000)).write.parquet(path)
    source = {"format": "parquet", "path": path}
    stream = silver.parse_ticks(
        messages.bronze_envelope(messages.read_message_stream(t.spark, source, TOPIC, "earliest"))
    )
    once = streams.stream_dedup(
        stream, ["symbol", "event_time"], "event_time", "1 hour", spread_by="offset"
    )
    out = scratch_dir(t.spark, "once")
    finished(
        lake.append_stream(
            once.select("symbol", "event_time"), out, scratch_dir(t.spark, "checkpoint"), CATCH_UP
        )
    )
    return t.spark.read.parquet(out)


def landed_feed(t: Tables, sent, topic: str):
    """Payloads as broker messages, streamed into a bronze folder in three batches and read back."""
    source, path = scratch_dir(t.spark, "feed"), scratch_dir(t.spark, "bronze")
    size = sent.agg(F.sum(F.octet_length("raw_value").cast("bigint"))).first()[0] or 0
    sent.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("raw_value", "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    ).repartition(max(3, math.ceil(size / FEED_FILE_BYTES))).write.parquet(source)
    finished(
        streams.bronze_stream(
            t.spark, {"format": "parquet", "path": source, **files_per_batch(t.spark, source, 3)}, path,
            scratch_dir(t.spark, "checkpoint"), topic, "earliest", CATCH_UP,
        )
    )
    return lake.read_lake(t.spark, path, schemas.ENVELOPE)


@query(
    "r1_news",
    "select source, title, article_id::varchar as url, published_at, content, article_id as offset "
    "from news where title is not null and title <> ''",
    "news",
)
def _(t):
    sent = news_messages(t).withColumn("id", F.get_json_object("raw_value", "$.url"))
    rows = messages.parse_payload(landed_feed(t, sent, "crypto.news"), schemas.NEWS_PAYLOAD, keep=["offset"])
    return rows.filter(F.col("title") != "").select(
        "source", "title", "url", temporal.iso_timestamp(F.col("published_at")).alias("published_at"),
        "content", "offset",
    )


@query(
    "r1_social",
    "select subreddit, post_id, text, score, created_utc::double as created_utc, type from social",
    "social",
)
def _(t):
    sent = social_messages(t).withColumn("id", F.monotonically_increasing_id())
    rows = messages.parse_payload(landed_feed(t, sent, "crypto.social"), schemas.SOCIAL_PAYLOAD)
    return rows.select(
        "subreddit", "post_id", "text", F.col("score").cast("int").alias("score"),
        F.col("created_utc").cast("double").alias("created_utc"), "type",
    )


@query("r5_idempotent_replay", CLEAN, "clean")
def _(t):
    table = silver_table(t)
    bronze = landed(t)
    for _attempt in (1, 2):  # the second stream has no checkpoint and sees everything again
        stream = lake.read_lake_stream(
            t.spark, bronze, schemas.ENVELOPE, files_per_batch(t.spark, bronze, 2)
        )
        finished(
            streams.silver_stream(
                stream, table, scratch_dir(t.spark, "checkpoint"), CATCH_UP, parts=DAYS
            )
        )
    return table.read().select("symbol", "price", "volume_24h", "event_time")


@query(
    "r6_stream_daily_bars",
    "select symbol, event_time::date as date, arg_min(price, event_time) as open_price, "
    "max(price) as high_price, min(price) as low_price, arg_max(price, event_time) as close_price, "
    "arg_max(volume_24h, event_time) as total_volume from clean group by 1, 2",
    "clean",
)
def _(t):
    stream = silver.passing(silver.parse_ticks(bronze_rows(t)), silver.tick_rules())
    bars = streams.stream_daily_bars(
        stream.withColumnRenamed("volume_24h", "volume"), "40 days"
    )
    table = lake.LakeTable(t.spark, scratch_dir(t.spark, "bars"), ["symbol", "date"], ["date"])
    finished(streams.keep_bars(bars, table, scratch_dir(t.spark, "checkpoint"), CATCH_UP))
    return table.read().select(
        "symbol", "date", "open_price", "high_price", "low_price", "close_price", "total_volume"
    )


@query(
    "r7_stream_alerts",
    "select id, user_id, a.symbol, condition, threshold from alerts a join (select symbol, "
    "max(price) as hi, min(price) as lo from ticks group by symbol) p on a.symbol = p.symbol "
    "where is_active and ((condition = 'above' and hi >= threshold) "
    "or (condition = 'below' and lo <= threshold))",
    "alerts ticks",
)
def _(t):
    out = scratch_dir(t.spark, "fired")
    stream = silver.parse_ticks(bronze_rows(t))
    finished(
        streams.stream_alerts(
            stream, t.alerts, out, scratch_dir(t.spark, "checkpoint"), trigger=CATCH_UP
        )
    )
    return t.spark.read.parquet(out).select(
        "id", "user_id", "symbol", "condition", "threshold"
    )


def alert_changes(t: Tables, version: int, active, path: str, where="true") -> None:
    """The alerts as one more file of changes."""
    changes = t.alerts().filter(where).select(
        "id", "user_id", "symbol", "condition", F.col("threshold").cast("double").alias("threshold"),
        active.alias("is_active"), F.lit(version).cast("long").alias("version"),
    )
    changes.coalesce(1).write.mode("append").parquet(path)


def fired_alerts(t: Tables, ticks, changes: str, out: str, checkpoint: str) -> None:
    stream = t.spark.readStream.schema(alerts.CHANGES).parquet(changes)
    finished(alerts.keep_fired(silver.parse_ticks(ticks), stream, out, checkpoint, trigger=CATCH_UP))


MET = (
    "select id, user_id, a.symbol, condition, threshold, is_active from alerts a join (select symbol, "
    "max(price) as hi, min(price) as lo from ticks group by symbol) p on a.symbol = p.symbol "
    "where (condition = 'above' and hi >= threshold) or (condition = 'below' and lo <= threshold)"
)


@query("r7_alert_state", f"select id, user_id, symbol, condition, threshold from ({MET}) where is_active", "alerts ticks")
def _(t):
    """The same with latches in operator state."""
    names = ("changes", "fired", "checkpoint")
    changes, out, checkpoint = (scratch_dir(t.spark, name) for name in names)
    alert_changes(t, 1, F.col("is_active"), changes)
    fired_alerts(t, bronze_rows(t), changes, out, checkpoint)
    return t.spark.read.schema(alerts.FIRED).parquet(out).select("id", "user_id", "symbol", "condition", "threshold")


@query(
    "r7_rearmed_alerts",
    f"select id, count(*) as times from (select id from ({MET}) where is_active union all "
    f"select id from ({MET}) where id % 3 = 0) group by id",
    "alerts ticks",
)
def _(t):
    """All ticks twice; in between, every third alert is switched off and on."""
    names = ("changes", "fired", "checkpoint", "bronze")
    changes, out, checkpoint, folder = (scratch_dir(t.spark, name) for name in names)
    alert_changes(t, 1, F.col("is_active"), changes)
    for version in (2, 4):
        t.bronze().write.mode("append").parquet(folder)
        ticks = lake.read_lake_stream(t.spark, folder, schemas.ENVELOPE)
        fired_alerts(t, ticks, changes, out, checkpoint)
        alert_changes(t, version, F.lit(False), changes, "id % 3 = 0")
        alert_changes(t, version + 1, F.lit(True), changes, "id % 3 = 0")
    fired = t.spark.read.schema(alerts.FIRED).parquet(out)
    return fired.groupBy("id").agg(F.count("*").alias("times"))


@query("r8_late_data", CLEAN, "clean")
def _(t):
    """Ticks that arrive after newer ones still reach silver, in their old partitions."""
    table = silver_table(t)
    bronze = t.bronze()
    middle = F.expr("timestamp'2024-01-16 12:00:00'")
    for late in (False, True):
        part = bronze.filter((F.col("kafka_timestamp") < middle) == F.lit(late))
        path = scratch_dir(t.spark, "arrivals")
        part.write.parquet(path)
        finished(
            streams.silver_stream(
                lake.read_lake_stream(t.spark, path, schemas.ENVELOPE),
                table, scratch_dir(t.spark, "checkpoint"), CATCH_UP, parts=DAYS,
            )
        )
    return table.read().select("symbol", "price", "volume_24h", "event_time")


def bars_with_late_ticks(t: Tables) -> str:
    """The newer half of the ticks is streamed first, then the older half; returns the folder."""
    folder, path, checkpoint = (scratch_dir(t.spark, n) for n in ("bars", "arrivals", "checkpoint"))
    for late in (False, True):
        older = F.col("kafka_timestamp") < F.expr("timestamp'2024-01-16 12:00:00'")
        t.bronze().filter(older == F.lit(late)).coalesce(1).write.mode("append").parquet(path)
        bronze = lake.read_lake_stream(t.spark, path, schemas.ENVELOPE)
        ticks = silver.passing(silver.parse_ticks(bronze), silver.tick_rules())
        finished(
            late_ticks.keep_bars_and_late(
                ticks.withColumnRenamed("volume_24h", "volume"), folder, checkpoint, "2 days", CATCH_UP
            )
        )
    return folder


@query(
    "r8_bars_with_late",
    "select symbol, event_time::date as date, arg_min(price, event_time) as open_price, "
    "max(price) as high_price, min(price) as low_price, arg_max(price, event_time) as close_price, "
    "arg_max(volume_24h, event_time) as total_volume from clean group by 1, 2",
    "clean",
)
def _(t):
    """Bars of days that were over long ago still get their late ticks."""
    states, _, _ = late_ticks.tables(t.spark, bars_with_late_ticks(t))
    return late_ticks.bars_of(states.read())


@query(
    "r8_late_ticks",
    "select symbol, price, volume_24h as volume, event_time, "
    "floor((epoch_us((select max(event_time) from clean)) - epoch_us(event_time)) / 1000)::bigint as late_by_ms "
    "from clean where event_time < timestamp '2024-01-16 12:00:00'",
    "clean",
)
def _(t):
    """What came late, and how late it was."""
    _, late, _ = late_ticks.tables(t.spark, bars_with_late_ticks(t))
    return late.read().select("symbol", "price", "volume", "event_time", "late_by_ms")


# -- end to end ------------------------------------------------------------------------


@query("p1_historical_chain", "select * from daily", "daily")
def _(t):
    """Dump files to bronze, silver and daily bars; the load is repeated and changes nothing."""
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    dump = t.kline_dump()
    chains.load_candles(store, dump, r"symbol=([^/]+)/")
    return chains.load_candles(store, dump, r"symbol=([^/]+)/")["gold_daily_ohlcv"]


@query(
    "p1_corrected_candle",
    "select symbol, date, open_price, high_price, low_price, close_price + 1 as close_price, "
    "total_volume from daily",
    "daily",
)
def _(t):
    """All closes are corrected by a second dump, which reaches the bars."""
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    chains.load_candles(store, t.kline_dump(), r"symbol=([^/]+)/")
    again = t.kline_dump(close=F.col("close") + 1)
    return chains.load_candles(store, again, r"symbol=([^/]+)/")["gold_daily_ohlcv"]


DAY_5 = "date_part('day', open_time) = 5"


@query(
    "p1_recomputed_days",
    f"select distinct symbol, open_time::date as date, false as gone from klines where {DAY_5}",
    "klines",
)
def _(t):
    """A second dump corrects one day: only that day's bars are computed again."""
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    chains.load_candles(store, t.kline_dump(), r"symbol=([^/]+)/")
    again = t.kline_dump(close=F.col("close") + F.when(F.dayofmonth("open_time") == 5, 1).otherwise(0))
    return chains.load_candles(store, again, r"symbol=([^/]+)/")["recomputed"]


@query(
    "p1_removed_candles",
    "select symbol, open_time::date as date, arg_min(open, open_time) as open_price, max(high) as "
    "high_price, min(low) as low_price, arg_max(close, open_time) as close_price, sum(volume) as "
    f"total_volume from klines where not ({DAY_5}) and date_part('hour', open_time) <> 7 group by 1, 2",
    "klines",
)
def _(t):
    """Candles of a day and of an hour are taken out of silver; the bars follow."""
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    chains.load_candles(store, t.kline_dump(), r"symbol=([^/]+)/")
    stored = store.table("silver", "historical")
    gone = (F.dayofmonth("open_time") == 5) | (F.hour("open_time") == 7)
    stored.overwrite(stored.read().filter(~gone))
    names = ("gold_daily_ohlcv", "daily_bar_digests", "candle_file_stamps")
    gold_tables_ = [store.table("gold", name) for name in names]
    increments.refresh_bars(stored, *gold_tables_)
    return gold_tables_[0].read()


@query(
    "p1_reload_bad_rows",
    "select symbol, reject_reason, n, stored from (select symbol, 'open_time_null' as reject_reason, "
    "count(*) as n from klines where date_part('hour', open_time) = 5 group by symbol), "
    "(select count(*) as stored from klines where date_part('hour', open_time) <> 5)",
    "klines",
)
def _(t):
    """Candles without a readable time are listed, and three loads are one load."""
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    opened = F.unix_millis(F.col("open_time").cast("timestamp")).cast("string")
    dump = t.kline_dump(opened=F.when(F.hour("open_time") == 5, F.lit('"soon"')).otherwise(opened))
    for _load in range(3):
        out = chains.load_candles(store, dump, r"symbol=([^/]+)/")
    stored = store.bronze_candles().read().agg(F.count("*")).scalar()
    return (
        out["rejected"].groupBy("symbol", "reject_reason").agg(F.count("*").alias("n"))
        .withColumn("stored", stored)
    )


@query(
    "p2_prices_chain",
    "select symbol, event_time::date as date, arg_min(price, event_time) as open_price, "
    "max(price) as high_price, min(price) as low_price, arg_max(price, event_time) as close_price, "
    "arg_max(volume_24h, event_time) as total_volume from clean "
    "where event_time::date = (select d from as_of) group by 1, 2",
    "clean as_of",
)
def _(t):
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"), tick_parts=DAYS)
    return chains.load_prices(store, t.message_source(), t.as_of())["daily_market_summary"]


def news_messages(t: Tables):
    stamp = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    article = jsontext.encode(
        "source", "title", F.col("article_id").cast("string").alias("url"),
        stamp.alias("published_at"), "content",
    )
    return t.news().select(article.alias("raw_value"), F.current_timestamp().alias("ingested_at"))


# Days and symbols of scored titles, every column of the mood table.
TITLE_MOOD = (
    "select *, case when avg_sentiment_score > 0.2 then 'Bullish' when avg_sentiment_score < -0.2 then "
    "'Bearish' else 'Neutral' end as market_mood from (select date_trunc('day', published_at)::timestamp "
    f"as sentiment_date, {batch.TAG} as symbol, round(avg(case when p + n > 0 then (p - n)::double / "
    "(p + n) else 0 end), 8) as avg_sentiment_score, count(*) as total_articles, "
    "count(*) filter (p > n) as positive_count, count(*) filter (p < n) as negative_count, "
    f"count(*) filter (p = n) as neutral_count from (select *, {batch.title_hits(batch.POS)} as p, "
    f"{batch.title_hits(batch.NEG)} as n from news) group by 1, 2)"
)


@query("p3_news_chain", TITLE_MOOD, "news")
def _(t):
    """Two loads, the second of all articles again: none is stored or scored twice."""
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    rate = lambda df: scoring.lexicon_sentiment(df, "title", batch.POS, batch.NEG)
    first = news_messages(t)
    chains.load_news(store, first.filter(F.pmod(F.xxhash64("raw_value"), F.lit(2)) == 0), rate)
    market = chains.load_news(store, first, rate)["market_sentiment"]
    return market.withColumn("avg_sentiment_score", F.round("avg_sentiment_score", 8))


@query(
    "p3_social_chain",
    "select subreddit, post_id, text, created_utc, make_timestamp(created_utc * 1000000) "
    "as created_at, type from social where text is not null",
    "social",
)
def _(t):
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    sent = social_messages(t)
    # The feed sends every post twice.
    return chains.load_social(store, sent.unionByName(sent)).select(
        "subreddit", "post_id", "text", "created_utc", "created_at", "type"
    )


@query(
    "p3_social_second_load",
    "select subreddit, post_id, case when created_utc % 3 = 0 then text || '!' else text end as text, "
    "created_utc from social where text is not null",
    "social",
)
def _(t):
    """Three loads: some posts, the others, and a third of them again with another text."""
    store = chains.Lake(t.spark, scratch_dir(t.spark, "lake"))
    half = F.pmod(F.xxhash64("raw_value"), F.lit(2)) == 0
    chains.load_social(store, social_messages(t).filter(half))
    chains.load_social(store, social_messages(t).filter(~half))
    edited = t.social().filter("created_utc % 3 = 0").withColumn("text", F.concat("text", F.lit("!")))
    stored = chains.load_social(store, social_messages(t, edited))
    return stored.select("subreddit", "post_id", "text", "created_utc")


def social_messages(t: Tables, posts=None):
    post = jsontext.encode("subreddit", "post_id", "title", "text", "score", "num_comments",
                           "created_utc", "url", "type")
    posts = t.social() if posts is None else posts
    return posts.select(post.alias("raw_value"), F.current_timestamp().alias("ingested_at"))


def gold_tables(t: Tables):
    return gold.build_gold(
        t.ticks(), t.klines(), t.news_sentiment(), t.as_of(), normalize=False,
        write_to=scratch_dir(t.spark, "gold"),
    )


GOLD_ROWS = (
    "select 'gold_daily_ohlcv' as model, symbol, date::varchar as day, open_price as a, close_price as b, "
    "total_volume as c from daily union all "
    "select 'daily_market_summary', symbol, date::varchar, open_price, close_price, total_volume "
    "from summary union all "
    "select 'gold_latest_prices', symbol, last_updated::date::varchar, latest_price, latest_volume_24h, "
    "null from latest_prices union all "
    "select 'market_sentiment', symbol, sentiment_date::date::varchar, round(avg_sentiment_score, 8), "
    "total_articles, positive_count from mood union all "
    "select 'gold_dashboard_stats', coalesce(p.symbol, m.symbol), m.sentiment_date::date::varchar, "
    "latest_price, round(avg_sentiment_score, 8), "
    "(select count(*) from latest_prices where latest_price > 1) from latest_prices p full outer join "
    "(select * from mood qualify row_number() over (partition by symbol order by sentiment_date desc) "
    "= 1) m on p.symbol = m.symbol"
)


@query("p4_build_gold", GOLD_ROWS, "daily latest_prices mood summary")
def _(t):
    """Every row of every gold table, as a day and three values."""
    values = {
        "gold_daily_ohlcv": ("date", "open_price", "close_price", "total_volume"),
        "daily_market_summary": ("date", "open_price", "close_price", "total_volume"),
        "gold_latest_prices": ("last_updated", "latest_price", "latest_volume_24h", None),
        "market_sentiment": ("sentiment_date", "avg_sentiment_score", "total_articles", "positive_count"),
        "gold_dashboard_stats": (
            "last_sentiment_update", "latest_price", "avg_sentiment_score", "active_coins"
        ),
    }
    parts = []
    for name, df in gold_tables(t).items():
        day, *columns = values[name]
        numbers = [
            F.round(F.col(c).cast("double"), 8) if c == "avg_sentiment_score"
            else F.col(c).cast("double") if c else F.lit(None).cast("double")
            for c in columns
        ]
        parts.append(
            df.select(
                F.lit(name).alias("model"), "symbol",
                F.col(day).cast("date").cast("string").alias("day"),
                *[n.alias(label) for n, label in zip(numbers, "abc")],
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "q7_run_assertions",
    "select * from (values ('low_le_high', 'daily_market_summary'), "
    "('score_range', 'market_sentiment'), ('unique_symbol', 'gold_latest_prices'), "
    "('unique_symbol_date', 'daily_market_summary')) v(rule, \"table\"), lateral (select case rule "
    "when 'low_le_high' then (select count(*) from summary where low_price > high_price) "
    "when 'score_range' then (select count(*) from mood where avg_sentiment_score not between "
    "-1 and 1) when 'unique_symbol' then (select count(*) from (select symbol from latest_prices "
    "group by 1 having count(*) > 1)) else (select count(*) from (select symbol from summary "
    "group by symbol, date having count(*) > 1)) end as failing_rows) "
    "union all select 'latest_price_null', 'gold_dashboard_stats', (select count(distinct symbol) "
    "from mood where symbol not in (select symbol from latest_prices))",
    "summary mood latest_prices",
)
def _(t):
    wanted = {
        "low_le_high", "score_range", "unique_symbol", "unique_symbol_date", "not_null_latest_price"
    }
    report = quality.run_assertions(gold_tables(t), quality.gold_rules())
    named = report.filter(
        F.col("rule").isin(list(wanted))
        & ~((F.col("rule") == "not_null_latest_price") & (F.col("table") == "gold_latest_prices"))
        & ~((F.col("rule") == "unique_symbol") & (F.col("table") == "gold_dashboard_stats"))
    )
    return named.select(
        F.when(F.col("rule") == "not_null_latest_price", "latest_price_null")
        .otherwise(F.col("rule"))
        .alias("rule"),
        "table",
        "failing_rows",
    )


STATS = (
    "(select coalesce(p.symbol, m.symbol) as symbol, latest_price, last_updated, "
    "count(case when latest_price > 1 then 1 end) over () as active_coins from latest_prices p "
    "full outer join (select distinct symbol from mood) m on p.symbol = m.symbol)"
)
BAR = "symbol date open_price high_price low_price close_price total_volume"
# Table -> its rows in SQL and the columns that must not be null.
REQUIRED = {
    "daily_market_summary": ("summary", BAR),
    "gold_daily_ohlcv": ("daily", BAR),
    "gold_latest_prices": ("latest_prices", "symbol latest_price latest_volume_24h last_updated"),
    "market_sentiment": (
        "mood",
        "sentiment_date symbol avg_sentiment_score total_articles positive_count negative_count "
        "neutral_count",
    ),
    "gold_dashboard_stats": (STATS, "symbol latest_price last_updated active_coins"),
}
FAILING = [
    (f"not_null_{col}", table, f"select 1 from {rows} where {col} is null")
    for table, (rows, cols) in REQUIRED.items()
    for col in cols.split()
] + [
    (
        f"unique_{'_'.join(cols)}", table,
        f"select 1 from {REQUIRED[table][0]} group by {', '.join(cols)} having count(*) > 1",
    )
    for table, cols in (
        ("gold_latest_prices", ["symbol"]),
        ("gold_dashboard_stats", ["symbol"]),
        ("daily_market_summary", ["symbol", "date"]),
    )
] + [
    ("low_le_high", "daily_market_summary", "select 1 from summary where low_price > high_price"),
    ("volume_positive", "daily_market_summary", "select 1 from summary where total_volume <= 0"),
    (
        "score_range", "market_sentiment",
        "select 1 from mood where avg_sentiment_score < -1 or avg_sentiment_score > 1",
    ),
]


@query(
    "q7_full_report",
    "select *, failing_rows = 0 as passed from ("
    + " union all ".join(
        f"select '{rule}' as rule, '{table}' as \"table\", "
        f"(select count(*) from ({failing})) as failing_rows"
        for rule, table, failing in FAILING
    )
    + ")",
    "summary daily latest_prices mood",
)
def _(t):
    return chains.check_gold(gold_tables(t))


@query(
    "u5_change_rules",
    "select event_id, case when symbol = 'VIEW' then 'operation_unknown' else 'condition_invalid' "
    "end as reject_reason from ticks where symbol = 'VIEW' or price > 100",
    "ticks",
)
def _(t):
    kind = F.col("symbol")
    log = t.ticks().select(
        "event_id",
        F.when(kind == "VIEW", "look").otherwise("insert").alias("op"),
        F.when(F.col("price") > 100, "near").otherwise("above").alias("condition"),
    )
    return silver.quarantine(log, accounts.change_rules()).select("event_id", "reject_reason")
