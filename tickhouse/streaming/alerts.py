"""Alerts on a tick stream with their latches in operator state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickhouse.sources.lake import append_stream
from tickhouse.streaming.ticks import EVERY_30_SECONDS, Trigger

# A symbol's alerts are spread over so many groups, so that a popular symbol is no single task.
SLICES = 16
CHANGES = (
    "id bigint, user_id bigint, symbol string, condition string, threshold double, "
    "is_active boolean, version bigint"
)
FIRED = (
    "id bigint, user_id bigint, symbol string, condition string, threshold double, current_price double"
)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def reduced_ticks(ticks: DataFrame) -> DataFrame:
    """symbol, high, low, last and last_at of the ticks that a task has in an Arrow batch.

    Reduced before the shuffle: what reaches the state is a few rows per task and symbol, however
    many ticks there are.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by("event_time")
            found = table.group_by("symbol", use_threads=False).aggregate(
                [("price", "max"), ("price", "min"), ("price", "last"), ("event_time", "max")]
            )
            found = found.select(["symbol", "price_max", "price_min", "price_last", "event_time_max"])
            yield from found.rename_columns(["symbol", "high", "low", "last", "last_at"]).to_batches()

    clean = ticks.filter(F.col("symbol").isNotNull() & F.col("price").isNotNull() & F.col("event_time").isNotNull())
    return clean.select(
        F.upper("symbol").alias("symbol"), F.col("price").cast("double").alias("price"), "event_time"
    ).mapInArrow(reduce, "symbol string, high double, low double, last double, last_at timestamp")


class AlertLatches(StatefulProcessor):
    """Of one symbol and slice: the alerts that wait for their price, and those that have fired.

    An alert fires once and is latched until a change switches it off; switched on again, it waits
    anew. Only waiting alerts are looked at when a price comes. Alerts that are off are not
    held at all, because the change that switches them on has all their columns.
    """

    def __init__(self, look_at: str):
        self.look_at = look_at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getMapState(
            "waiting", "id bigint", "user_id bigint, condition string, threshold double"
        )
        self.latched = handle.getMapState("latched", "id bigint", "user_id bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        changes, prices = [], []
        for part in rows:
            is_change = part["id"].notna()
            changes.append(part[is_change])
            prices.append(part[~is_change])
        # A batch's changes are applied before its prices.
        for change in pd.concat(changes).sort_values("version").itertuples():
            self.apply(change)
        prices = pd.concat(prices)
        if len(prices):
            fired = self.fire(key[0], prices)
            if fired:
                names = [field.split()[0] for field in FIRED.split(", ")]
                yield pd.DataFrame(fired, columns=names)

    def apply(self, change) -> None:
        number = (int(change.id),)
        if not change.is_active:
            self.waiting.removeKey(number)
            self.latched.removeKey(number)
        elif not self.latched.containsKey(number):
            user = None if pd.isna(change.user_id) else int(change.user_id)
            self.waiting.updateValue(number, (user, change.condition, float(change.threshold)))

    def fire(self, symbol: str, prices: pd.DataFrame) -> list[tuple]:
        if self.look_at == "last":
            high = low = float(prices.sort_values("last_at")["last"].iloc[-1])
        else:
            high, low = float(prices["high"].max()), float(prices["low"].min())
        met = []
        for (number,), (user, condition, threshold) in self.waiting.iterator():
            if condition == "above" and high >= threshold:
                met.append((number, user, symbol, condition, threshold, high))
            elif condition == "below" and low <= threshold:
                met.append((number, user, symbol, condition, threshold, low))
        for number, user, *_ in met:
            self.waiting.removeKey((number,))
            self.latched.updateValue((number,), (user,))
        return met


def latched_alerts(
    ticks: DataFrame, changes: DataFrame, look_at: str = "extremes", slices: int = SLICES
) -> DataFrame:
    """The alerts that fire, as a stream, from streams of ticks and of changes to alerts.

    ``changes`` has the columns of ``CHANGES``, a row for each new, altered or switched alert; an id
    keeps its symbol, and of changes in one batch ``version`` gives the order. ``extremes`` fires on
    any price of a batch, ``last`` on its newest. The session must keep state in RocksDB.
    """
    if look_at not in ("extremes", "last"):
        raise ValueError(f"unknown look_at {look_at!r}")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    prices = reduced_ticks(ticks).select("*", everywhere.alias("slice"))
    asked = changes.select(
        F.upper("symbol").alias("symbol"),
        F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice"),
        "id", "user_id", "condition", F.col("threshold").cast("double").alias("threshold"),
        "is_active", "version",
    ).filter(F.col("id").isNotNull() & F.col("symbol").isNotNull() & F.col("threshold").isNotNull())
    both = prices.unionByName(asked, allowMissingColumns=True)
    return both.groupBy("symbol", "slice").transformWithStateInPandas(
        statefulProcessor=AlertLatches(look_at),
        outputStructType=FIRED,
        outputMode="Append",
        timeMode="None",
    )


def keep_fired(
    ticks: DataFrame,
    changes: DataFrame,
    path: str,
    checkpoint: str,
    look_at: str = "extremes",
    trigger: Trigger = EVERY_30_SECONDS,
    slices: int = SLICES,
) -> StreamingQuery:
    """Append the alerts that fire to ``path``.

    What a batch costs is the waiting alerts of the symbols it has, not what ever fired; a
    restart goes on with the latches of the checkpoint.
    """
    ticks.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return append_stream(latched_alerts(ticks, changes, look_at, slices), path, checkpoint, trigger)
