"""Query op10: ids of all documents in grammar-compressed files, read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import grammar
from tickhouse.llm.registry import register, table
from tickhouse.session import scratch_dir

END_ID = 1


@register("op10_repair_files")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "repair")
    path = public_tokenizers.path("word_bpe_49k.json")
    grammar.write_files(table(spark, sf_dir, "documents"), path, END_ID, folder)
    return grammar.read_files(spark, folder)
