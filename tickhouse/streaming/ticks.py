"""Tick streams: bronze and silver tables, deduplication, daily bars, alerts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickhouse.operators.accounts import evaluate_alerts
from tickhouse.operators.bars import latest_prices, merge_latest
from tickhouse.operators.silver import silver_ticks, stg_prices
from tickhouse.session import settle
from tickhouse.sources.lake import LakeTable, append_stream
from tickhouse.sources.messages import bronze_envelope, read_message_stream
from tickhouse.sources.serving import jdbc_stream_append

Trigger = Mapping[str, object]
EVERY_30_SECONDS: Trigger = {"processingTime": "30 seconds"}
CATCH_UP: Trigger = {"availableNow": True}
# Fired alerts of so many batches share a folder.
BATCHES_PER_FOLDER = 1000

stream_to_serving = jdbc_stream_append


def bronze_stream(
    spark: SparkSession,
    source: Mapping[str, str],
    path: str,
    checkpoint: str,
    topic: str = "crypto.prices",
    starting: str | Mapping[int, int] = "latest",
    trigger: Trigger = EVERY_30_SECONDS,
    name: str | None = None,
    fmt: str = "parquet",
    positions: str | None = None,
    fail_on_data_loss: bool = False,
) -> StreamingQuery:
    """Land a topic's messages unparsed, with their position and arrival time."""
    raw = read_message_stream(spark, source, topic, starting, fail_on_data_loss, positions)
    return append_stream(bronze_envelope(raw), path, checkpoint, trigger, name, fmt)


def silver_stream(
    bronze: DataFrame,
    table: LakeTable,
    checkpoint: str,
    trigger: Trigger = EVERY_30_SECONDS,
    name: str | None = None,
    truncate_to: str | None = None,
    parts: tuple[str, ...] = ("year", "month", "day", "hour"),
    latest: LakeTable | None = None,
) -> StreamingQuery:
    """Keep a silver table up to date from bronze rows.

    The upsert both dedups a batch and replaces rows of earlier ones, so no streaming state is
    needed, a late tick still finds its partition, and a replayed batch changes nothing.
    ``latest`` is a table of the newest price per symbol to keep current with every batch, so
    that nobody has to read the whole history for it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        ticks = silver_ticks(batch, truncate_to, parts=parts)
        table.upsert(ticks)
        if latest is not None:
            fresh = latest_prices(stg_prices(ticks))
            latest.overwrite(
                merge_latest(latest.read(), fresh) if latest.exists() else fresh
            )

    return _foreach(bronze, write, checkpoint, trigger, name)


def stream_dedup(
    sdf: DataFrame,
    keys: Sequence[str],
    time: str,
    delay: str,
    spread_by: str | None = "offset",
    slices: int = 16,
) -> DataFrame:
    """The first row per key, remembering keys only as long as the watermark requires.

    A stateful operator cannot combine rows before its shuffle, so copies of one hot key would
    all meet in one task. ``spread_by`` (a column that differs between copies; the message offset,
    where there is one) dedups within slices of the copies first, and only one row per slice and
    key reaches the final step. None turns that off.
    """
    out = sdf.withWatermark(time, delay)
    if spread_by in sdf.columns:
        slice_of = F.pmod(F.xxhash64(spread_by), F.lit(slices))
        out = (
            out.withColumn("_slice", slice_of)
            .dropDuplicatesWithinWatermark([*keys, "_slice"])
            .drop("_slice")
        )
    return out.dropDuplicatesWithinWatermark(list(keys))


def stream_daily_bars(sdf: DataFrame, delay: str) -> DataFrame:
    """Daily bars of a tick stream, for update mode.

    Rows arrive in any order, so first and last are chosen by event time, and among ticks of one
    time by their offset where the stream has it, so price and volume come from one tick and a
    replay gives the same bar. Like the batch form, the volume is the last rolling total. Ticks
    behind the watermark no longer change a bar.
    """
    when = F.struct("event_time", "offset") if "offset" in sdf.columns else F.col("event_time")
    bars = (
        sdf.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day").alias("w"), "symbol")
        .agg(
            F.min_by("price", when).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", when).alias("close_price"),
            F.max_by("volume", when).alias("total_volume"),
        )
    )
    return bars.select(
        "symbol",
        F.to_date("w.start").alias("date"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "total_volume",
    )


def keep_bars(
    bars: DataFrame, table: LakeTable, checkpoint: str, trigger: Trigger = EVERY_30_SECONDS
) -> StreamingQuery:
    """Upsert each batch's changed bars into a table keyed by symbol and date."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.upsert(batch)

    return _foreach(bars, write, checkpoint, trigger, output_mode="update")


def batch_extremes(ticks: DataFrame) -> DataFrame:
    """Highest and lowest price per symbol of a batch."""
    return ticks.groupBy("symbol").agg(
        F.max("price").alias("high_price"), F.min("price").alias("low_price")
    )


def batch_last(ticks: DataFrame) -> DataFrame:
    """The newest price per symbol of a batch, as a poll at its end would see it."""
    price = F.max_by("price", F.col("event_time"))
    return ticks.groupBy("symbol").agg(price.alias("high_price"), price.alias("low_price"))


def stream_alerts(
    ticks: DataFrame,
    alerts: Callable[[], DataFrame],
    fired_path: str,
    checkpoint: str,
    look_at: str = "extremes",
    trigger: Trigger = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Store every alert in ``fired_path`` when it fires; it fires again only after re-arming.

    A batch is reduced to one row per symbol before it meets the alerts, so the work is the
    size of the ticks plus the size of the alerts, never their product. ``extremes`` fires on
    any price in the batch; ``last`` on its newest price, as polling would. ``alerts`` is asked
    for the current alerts in every batch.

    ``<fired_path>_latch`` holds one row per alert that ever fired: the batch it last fired in and
    the batch that last found it switched off. An alert is latched from the first until the
    second. Both are only looked at as far as they are older than the running batch, so a replay
    comes to the same result. Fired alerts are keyed by alert and batch; batch numbers belong to a
    checkpoint, so a folder of fired alerts has one checkpoint for life.
    """
    reduce_batch = {"extremes": batch_extremes, "last": batch_last}[look_at]
    spark = ticks.sparkSession
    fired_schema = (
        "id bigint, user_id bigint, symbol string, condition string, threshold double, "
        "current_price double, batch_id bigint, batches bigint"
    )
    fired = LakeTable(spark, fired_path, ["id", "batch_id"], ["batches"], schema=fired_schema)
    latch = LakeTable(
        spark, f"{fired_path.rstrip('/')}_latch", ["id"], schema="id bigint, fired bigint, released bigint"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.lit(batch_id).cast("bigint")
        listed = alerts()
        hits = evaluate_alerts(listed, reduce_batch(batch), "high_price", "low_price")
        released = None
        if latch.exists():
            state = latch.read().filter(
                (F.col("fired") < now) & (F.col("released").isNull() | (F.col("released") >= now))
            )
            off = listed.filter(~F.col("is_active")).select("id")
            hits = hits.join(state.select("id"), "id", "left_anti")
            released = state.join(off, "id", "left_semi").withColumn("released", now)
        # Spark asks for the hits twice; they must not change when the latch does.
        hits = settle(
            hits.withColumns({"batch_id": now, "batches": F.floor(now / BATCHES_PER_FOLDER)}), "hits"
        )
        changed = hits.select("id", now.alias("fired"), F.lit(None).cast("bigint").alias("released"))
        if released is not None:
            changed = settle(changed.unionByName(released), "latch")
        if not hits.isEmpty():
            fired.upsert(hits)
        if not changed.isEmpty():
            latch.upsert(changed)

    return _foreach(ticks, write, checkpoint, trigger)


def _foreach(
    sdf: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger,
    name: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    writer = (
        sdf.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    return (writer.queryName(name) if name else writer).start()
