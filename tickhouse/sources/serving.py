"""Relational serving tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Properties = Mapping[str, str]


def jdbc_query(spark: SparkSession, url: str, sql: str, props: Properties) -> DataFrame:
    """The result of a query that the database runs."""
    return spark.read.jdbc(url, f"({sql}) q", properties=dict(props))


def jdbc_overwrite(df: DataFrame, url: str, table: str, props: Properties) -> bool:
    """Replace a serving table's rows, keeping its definition; an empty frame is skipped."""
    if df.isEmpty():
        return False
    df.write.option("truncate", True).jdbc(url, table, "overwrite", dict(props))
    return True


def jdbc_incremental_append(
    df: DataFrame,
    url: str,
    table: str,
    time_col: str,
    props: Properties,
    table_exists: bool = True,
) -> bool:
    """Append the rows newer than the serving table's newest; everything while it is empty.

    The database computes its own maximum and one value comes back. Whether the table exists is
    the caller's to say: a failed read is an error, never a reason to load everything again.
    """
    if table_exists:
        newest = jdbc_query(df.sparkSession, url, f"select max({time_col}) as newest from {table}", props)
        mark = newest.first()["newest"]
        if mark is not None:
            df = df.filter(F.col(time_col) > F.lit(mark))
    if df.isEmpty():
        return False
    df.write.jdbc(url, table, "append", dict(props))
    return True


def append_batch(
    batch: DataFrame,
    batch_id: int,
    url: str,
    table: str,
    keys: Sequence[str],
    props: Properties,
    batch_col: str = "batch_id",
    table_exists: bool = True,
) -> bool:
    """Append a micro-batch so that a replay of it adds only what the first try did not.

    Executors commit their partitions one by one, so a batch that failed half-way has left rows
    behind. They carry its number; the replay leaves their keys out.
    """
    if table_exists:
        done = jdbc_query(
            batch.sparkSession,
            url,
            f"select {', '.join(keys)} from {table} where {batch_col} = {int(batch_id)}",
            props,
        )
        batch = batch.join(done, list(keys), "left_anti")
    if batch.isEmpty():
        return False
    numbered = batch.withColumn(batch_col, F.lit(batch_id).cast("bigint"))
    numbered.write.jdbc(url, table, "append", dict(props))
    return True


def jdbc_stream_append(
    sdf: DataFrame,
    url: str,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    props: Properties,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append a stream to a serving table, batch by batch; by default until it has caught up."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, batch_id, url, table, keys, props)

    return (
        sdf.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
