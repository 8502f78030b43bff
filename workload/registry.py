"""Collects the queries and their oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.tables import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Session-zone timestamps as plain ones, so that engines compare the same wall clock."""
    return df.select(
        *[
            F.col(f"`{field.name}`").cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of the adapted tables, and the same query in SQL on ``views``."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The tables hold plain timestamps, which the oracle reads as UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(fn(Tables(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, *views.split())
        return fn

    return register
