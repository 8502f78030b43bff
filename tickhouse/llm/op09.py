"""Query op9: all documents packed into sequences of 1024 tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import packing
from tickhouse.llm.registry import register, table

CAPACITY = 1024
END_ID = 2


@register("op9_configuration_packing")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, END_ID, CAPACITY)
