"""Query op2: toxicity scores of all documents, learned from the labels that are not held out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import toxicity
from tickhouse.llm.registry import register, table

CUTOFF = 0.3


def held_out():
    """Rows whose labels are never learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def model_of(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


@register("op2_subword_toxicity")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_scores(docs, model_of(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )
