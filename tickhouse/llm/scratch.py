"""Tables of one computation in the shared folder, deleted together once its results are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.session import scratch_dir, settle


class Scratch:
    """Keeps intermediate tables until :meth:`finish`, which leaves only the results.

    Tables cut lineage: if an executor is lost, its work is done again from them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = scratch_dir(spark, "work")
        self.tables = 0
        self.paths: dict[int, tuple[str, DataFrame]] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it from there."""
        self.tables += 1
        path = f"{self.folder}/{self.tables}-{name}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = (path, table)
        return table

    def free(self, *tables: DataFrame) -> None:
        """Delete tables of :meth:`keep` that nothing reads any more."""
        for df in tables:
            self._delete(self.paths.pop(id(df))[0])
        # Spark deletes the shuffle files of jobs that are over when the driver collects its garbage.
        self.spark.sparkContext._jvm.System.gc()

    def finish(self, *results: DataFrame) -> list[DataFrame]:
        """The results, written outside of this folder, which is then deleted."""
        written = [settle(df, "result") for df in results]
        self._delete(self.folder)
        return written

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
