"""Query op8: counts and the verdict of the quality rules for all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import quality
from tickhouse.llm.registry import register, table


@register("op8_adaptive_quality")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )
