"""Query op4: tokens of every line of all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import attribution
from tickhouse.llm.registry import register, table


@register("op4_offset_attribution")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return attribution.attribute_tokens(attribution.with_line_sections(docs), path)
