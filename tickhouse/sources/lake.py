"""Lake tables on plain Parquet: read, append, partitioned write, upsert and compaction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tickhouse.operators.dedup import dedup_keys
from tickhouse.session import settle


def read_lake(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_lake_stream(
    spark: SparkSession, path: str, schema: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A table as a stream of the files appended to it; the schema is declared."""
    return spark.readStream.schema(schema).options(**(options or {})).parquet(path)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Start a named append-only file sink with its checkpoint."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def write_partitioned(
    df: DataFrame, path: str, mode: str = "append", parts: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Write by partition columns with files of a sensible size.

    Rebalancing (not ``repartition``) on the partition columns lets AQE cut a partition that
    holds most of the rows into several tasks and merge the small ones.
    """
    out = df.hint("rebalance", *parts) if parts else df
    writer = out.write.format(fmt).mode(mode)
    if mode == "overwrite":
        # A full overwrite replaces the table, whatever the session's default is.
        writer = writer.option("partitionOverwriteMode", "static")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)


class LakeTable:
    """A Parquet table with a unique key, and partition columns that the key determines.

    ``upsert`` appends rows with new keys and rewrites only the partitions in which a key is
    already stored, by Spark's dynamic partition overwrite, which writes all new files before it
    replaces the old ones. Doing an upsert again changes nothing, so a batch that failed half-way
    can simply be repeated. There is one writer at a time, and reading never writes. Plain files
    have no transactions: a driver lost in the middle of the final exchange of files leaves
    that to the repetition, which a table format with its own MERGE would avoid.

    A row without a value in a key or partition column has no place in the table. Such rows are
    never written; ``upsert`` returns them with a reason.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        order_by: Sequence[Column] = (),
        schema: str | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.partition_by = list(partition_by)
        self.order_by = list(order_by)
        # Without a declared schema Spark guesses the types of the partition columns.
        self.schema = schema

    # -- reading ---------------------------------------------------------------------

    def exists(self) -> bool:
        """Whether the folder holds a data file; markers and hidden files do not count."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return False
        found = fs.listFiles(target, True)
        while found.hasNext():
            if found.next().getPath().getName()[0] not in "_.":
                return True
        return False

    def read(self) -> DataFrame:
        return read_lake(self.spark, self.path, self.schema)

    # -- writing ---------------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> None:
        """Replace everything; ``df`` may read the table itself."""
        content = settle(df, "overwrite") if self.exists() else df
        write_partitioned(content, self.path, "overwrite", self.partition_by)

    def append(self, df: DataFrame) -> None:
        write_partitioned(df, self.path, "append", self.partition_by)

    def without_place(self, rows: DataFrame) -> Column:
        """Why a row cannot be stored; null if it can."""
        reason = F.lit(None).cast("string")
        for name in reversed([*self.keys, *self.partition_by]):
            if name in rows.columns:
                reason = F.when(F.col(name).isNull(), F.lit(f"{name}_null")).otherwise(reason)
        return reason

    def upsert(self, updates: DataFrame, compare: Sequence[str] = ()) -> DataFrame:
        """Replace the rows whose key is in ``updates`` and insert the others.

        Of several updates of one key the one that ``order_by`` puts first wins. With
        ``compare``, rows that are stored with the same key and the same values of these
        columns are left out first, so that a source that repeats its whole history rewrites
        only the partitions in which something changed. Returns the rows that cannot be stored,
        with ``reject_reason``.
        """
        reasoned = updates.withColumn("reject_reason", self.without_place(updates))
        rejected = reasoned.filter(F.col("reject_reason").isNotNull())
        placed = reasoned.filter(F.col("reject_reason").isNull()).drop("reject_reason")
        latest = dedup_keys(placed, self.keys, self.order_by)
        if not self.exists():
            self.append(latest)
            return rejected
        if compare:
            latest = settle(self._changed(latest, compare), "changed")
        # Read several times below; if an executor is lost, Spark recomputes its share.
        latest = latest.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.partition_by:
                self._upsert_partitions(latest)
            else:
                self._upsert_all(latest)
        finally:
            latest.unpersist()
        return rejected

    def compact(self, target_bytes: int = 128 << 20) -> None:
        """Merge the files of partitions that hold far more files than their size needs.

        Only the list of files is read to find them. Partitions that are packed well are left
        alone.
        """
        table = self.read()
        if not self.partition_by:
            self.overwrite(table)
            return
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(self.path)
        kinds = [F.col(n).cast(table.schema[n].dataType).alias(n) for n in self.partition_by]
        loose = (
            files.groupBy(*kinds)
            .agg(F.count("*").alias("_files"), F.sum("length").alias("_bytes"))
            .filter(F.col("_files") > 2 * F.ceil(F.col("_bytes") / target_bytes))
            .select(*self.partition_by)
        )
        if not loose.isEmpty():
            self._rewrite(self._inside(table, loose))

    # -- internals -------------------------------------------------------------------

    def _changed(self, updates: DataFrame, compare: Sequence[str]) -> DataFrame:
        stored = self.read().select(*self.keys, *compare).alias("s")
        equal = [F.col(f"s.{name}") == F.col(f"u.{name}") for name in self.keys]
        equal += [F.col(f"s.{name}").eqNullSafe(F.col(f"u.{name}")) for name in compare]
        return updates.alias("u").join(stored, equal, "left_anti")

    def _inside(self, rows: DataFrame, partitions: DataFrame) -> DataFrame:
        """Rows of these partitions; Spark prunes the scan of a table by them at run time."""
        return rows.join(partitions, self.partition_by, "left_semi")

    def _upsert_all(self, latest: DataFrame) -> None:
        stored, keys = self.read(), latest.select(*self.keys)
        if stored.join(keys, self.keys, "left_semi").isEmpty():
            self.append(latest)
        else:
            kept = stored.join(keys, self.keys, "left_anti")
            self.overwrite(kept.unionByName(latest, allowMissingColumns=True))

    def _upsert_partitions(self, latest: DataFrame) -> None:
        keys = latest.select(*self.keys)
        touched = self._inside(self.read(), latest.select(*self.partition_by).distinct())
        known = touched.join(keys, self.keys, "left_semi").select(*self.partition_by).distinct()
        # Written, because a cached frame of this path is computed anew after the append below.
        known = settle(known, "known-partitions")
        if known.isEmpty():
            self.append(latest)
            return
        # The rows for other partitions go first, while every file that was read still exists;
        # a repetition after a crash in between finds them stored and replaces them.
        added = latest.join(known, self.partition_by, "left_anti")
        if not added.isEmpty():
            self.append(added)
        kept = self._inside(self.read(), known).join(keys, self.keys, "left_anti")
        updated = self._inside(latest, known)
        self._rewrite(kept.unionByName(updated, allowMissingColumns=True))

    def _rewrite(self, content: DataFrame) -> None:
        """Replace the partitions that ``content`` has, and no others."""
        (
            content.hint("rebalance", *self.partition_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partition_by)
            .parquet(self.path)
        )


def compact(
    spark: SparkSession, path: str, partition_by: Sequence[str] = (), schema: str | None = None
) -> None:
    """Merge the small files of a table."""
    LakeTable(spark, path, (), partition_by, schema=schema).compact()
