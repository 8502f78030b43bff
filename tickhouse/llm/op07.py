"""Query op7: repeated passages of 200 bytes in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import substrings
from tickhouse.llm.registry import register, table


@register("op7_prefix_doubling_dedup")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_report(table(spark, sf_dir, "documents"))
