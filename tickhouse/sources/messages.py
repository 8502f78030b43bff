"""Message streams: subscribe, envelope, parse, and standard payloads per source."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickhouse import schemas
from tickhouse.functions import jsontext
from tickhouse.sources.lake import LakeTable

# What a message broker hands out; file replays carry the same columns.
RAW_MESSAGE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

POSITIONS = "partition int, first_offset bigint, low bigint, high bigint"
# The broker's codes for the first and for the next message.
EARLIEST, LATEST = -2, -1


def read_message_stream(
    spark: SparkSession,
    source: Mapping[str, str],
    topic: str,
    starting: str | Mapping[int, int] = "latest",
    fail_on_data_loss: bool = False,
    positions: str | None = None,
) -> DataFrame:
    """Subscribe to one topic.

    ``source`` is ``{"format": "kafka", "kafka.bootstrap.servers": ...}`` or, to replay stored
    messages, ``{"format": "parquet", "path": ...}``. ``starting`` is "earliest", "latest" or an
    offset per partition, where -2 is the earliest and -1 the latest.

    Files have no notion of "from now on", so a replay starts with the earliest message unless
    ``positions`` names a table: there the offsets that ``starting`` means are written the first time,
    and a restart goes by them whatever is stored by then. With ``fail_on_data_loss`` a replay is
    refused that should start with a message which is not stored any more.
    """
    options = dict(source)
    kind = options.pop("format", "kafka")
    reader = spark.readStream.format(kind).options(**options)
    if kind == "kafka":
        if not isinstance(starting, str):
            starting = json.dumps({topic: {str(p): offset for p, offset in starting.items()}})
        return (
            reader.option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .load()
        )
    of_topic = F.col("topic") == topic
    stored = reader.schema(RAW_MESSAGE).load().filter(of_topic)
    if positions is None:
        return stored
    table = LakeTable(spark, positions, ["partition"], schema=POSITIONS)
    if not table.exists():
        known = spark.read.format(kind).schema(RAW_MESSAGE).load(options["path"]).filter(of_topic)
        table.append(starting_positions(known, starting))
    begin = table.read()
    if fail_on_data_loss:
        lost = begin.filter("first_offset < low").limit(5).collect()
        if lost:
            raise ValueError(f"messages of {topic} are lost: {[r.asDict() for r in lost]}")
    # A partition that is not listed had no message then, and is read from its beginning.
    begin = begin.select(F.col("partition").alias("_partition"), "first_offset")
    joined = stored.join(begin, F.col("partition") == F.col("_partition"), "left")
    wanted = F.col("first_offset").isNull() | (F.col("offset") >= F.col("first_offset"))
    return joined.filter(wanted).select(*stored.columns)


def starting_positions(stored: DataFrame, starting: str | Mapping[int, int]) -> DataFrame:
    """partition, first_offset to read, and low and high, the least and largest stored offset."""
    ends = stored.groupBy("partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    if isinstance(starting, str):
        codes = {"earliest": EARLIEST, "latest": LATEST}
        if starting not in codes:
            raise ValueError(f"unknown starting position {starting!r}")
        asked = ends.withColumn("asked", F.lit(codes[starting]).cast("bigint"))
    else:
        given = stored.sparkSession.createDataFrame(list(starting.items()), "partition int, asked bigint")
        asked = ends.join(given, "partition", "full").withColumn(
            "asked", F.coalesce("asked", F.lit(EARLIEST).cast("bigint"))
        )
    first = (
        F.when(F.col("asked") == EARLIEST, F.coalesce("low", F.lit(0)))
        .when(F.col("asked") == LATEST, F.coalesce(F.col("high") + 1, F.lit(0)))
        .otherwise(F.col("asked"))
    )
    return asked.select("partition", first.alias("first_offset"), "low", "high")


def offset_gaps(stored: DataFrame, step: int = 1, slice_size: int = 1 << 20) -> DataFrame:
    """topic, partition, after, before and missing: where the offsets of stored messages skip some.

    Messages that were lost, or dropped by retention or compaction. Offsets are compared within
    slices of ``slice_size``, and the ends of slices with each other, so a topic with one partition
    is not sorted by one task. ``step`` is the distance of neighbours without a gap.
    """
    place = ["topic", "partition"]
    sliced = stored.select(*place, "offset", F.floor(F.col("offset") / slice_size).alias("slice"))
    inside = Window.partitionBy(*place, "slice").orderBy("offset")
    pairs = sliced.select(*place, F.lag("offset").over(inside).alias("after"), F.col("offset").alias("before"))
    ends = sliced.groupBy(*place, "slice").agg(F.min("offset").alias("before"), F.max("offset").alias("last"))
    along = Window.partitionBy(*place).orderBy("slice")
    across = ends.select(*place, F.lag("last").over(along).alias("after"), "before")
    return (
        pairs.unionByName(across)
        .filter(F.col("before") - F.col("after") > step)
        .withColumn("missing", F.expr(f"(before - after) div {int(step)} - 1"))
    )


def bronze_envelope(raw: DataFrame) -> DataFrame:
    """Key and value as text plus the position of the message and its arrival time."""
    return raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingested_at"),
    )


def parse_payload(
    df: DataFrame, schema: str, col: str = "raw_value", keep: Sequence[str] = ()
) -> DataFrame:
    """JSON text to the declared columns; ``keep`` names envelope columns to carry along.

    The fields come out of a generator, so that each text is parsed once: a filter on a field
    would otherwise be pushed below the parser and parse the text again for every condition.
    """
    parsed = df.select(*keep, F.inline(F.array(jsontext.decode(F.col(col), schema))))
    return parsed.select(*[c for c in parsed.columns if c not in keep], *keep)


@dataclass(frozen=True)
class FieldMap:
    """How one source's own message becomes the standard payload."""

    raw_schema: str
    fields: Mapping[str, Column | str]


def field_map(source: str) -> FieldMap:
    """The field map of ``ticker``, ``market``, ``article`` or ``feed``.

    The first name is the target; a string is the raw field it is copied from.
    """
    m = F.col("m").getField
    # A polled source has no event time of its own: its payload is stamped on arrival.
    arrival = F.unix_millis(F.col("arrived_at"))
    if source == "ticker":
        return FieldMap(
            "s string, c string, v string, E bigint",
            {
                "symbol": m("s"),
                "price": F.coalesce(m("c").try_cast("double"), F.lit(0.0)),
                "volume_24h": F.coalesce(m("v").try_cast("double"), F.lit(0.0)),
                "timestamp": m("E"),
                "source": F.lit("binance"),
            },
        )
    if source == "market":
        return FieldMap(
            "symbol string, name string, current_price double, market_cap double, "
            "market_cap_rank int, total_volume double, price_change_percentage_24h double",
            {
                "symbol": F.upper(F.coalesce(m("symbol"), F.lit(""))),
                "name": m("name"),
                "price": m("current_price"),
                "market_cap": m("market_cap"),
                "market_cap_rank": m("market_cap_rank"),
                "total_volume": m("total_volume"),
                "price_change_percentage_24h": m("price_change_percentage_24h"),
                "timestamp": arrival,
                "source": F.lit("coingecko"),
            },
        )
    if source == "article":
        return FieldMap(
            "source struct<name string>, author string, title string, description string, "
            "url string, publishedAt string, content string",
            {
                "source": m("source").getField("name"),
                "author": m("author"),
                "title": m("title"),
                "description": m("description"),
                "url": m("url"),
                "published_at": m("publishedAt"),
                "content": m("content"),
                "timestamp": arrival,
            },
        )
    if source == "feed":
        return FieldMap(
            "feed string, id string, title string, summary string, link string",
            {
                "subreddit": m("feed"),
                "post_id": F.coalesce(m("id"), m("link")),
                "title": F.coalesce(m("title"), F.lit("")),
                "text": F.coalesce(m("summary"), F.lit("")),
                "score": F.lit(0),
                "num_comments": F.lit(0),
                "created_utc": F.unix_seconds(F.col("arrived_at")),
                "url": m("link"),
                "timestamp": arrival,
                "type": F.lit("rss_opinion"),
            },
        )
    raise ValueError(f"unknown source {source!r}")


def normalize_payload(
    raw: DataFrame, source: str, col: str = "raw_value", arrived_at: Column | None = None
) -> DataFrame:
    """A source's raw JSON messages to its standard payload columns."""
    fields = field_map(source)
    arrived = F.current_timestamp() if arrived_at is None else arrived_at
    parsed = jsontext.decode(F.col(col), fields.raw_schema)
    messages = raw.select(F.explode(F.array(parsed)).alias("m"), arrived.alias("arrived_at"))
    return messages.select(*[expr.alias(name) for name, expr in fields.fields.items()])


PAYLOADS = {
    "ticker": schemas.TICK_PAYLOAD,
    "market": schemas.MARKET_PAYLOAD,
    "article": schemas.NEWS_PAYLOAD,
    "feed": schemas.SOCIAL_PAYLOAD,
}
