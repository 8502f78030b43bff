"""A training corpus from documents: stages of the llm operators, each written and read again.

Every stage takes what its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import decontaminate, ngram_join, op02, op09, packing, substrings, toxicity
from tickhouse.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the cutoff by a model of the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~op02.held_out())
    names = docs.columns
    model = toxicity.fit(docs, labels)
    mine = docs.toDF(*[f"_{i}" for i in range(len(names))])
    text = f"_{names.index('text')}"
    scored = toxicity.with_scores(mine.withColumnRenamed(text, "text"), model)
    clean = scored.where(F.col("score") < op02.CUTOFF).withColumnRenamed("text", text)
    return clean.select(*mine.columns).toDF(*names)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least doc_id, then the least hash of its text, of each component of near copies.

    Rows with one doc_id and texts that are not linked all stay, each for its component; of rows with
    the same doc_id and text one stays, the least by its other columns written as JSON. Rows without a
    doc_id cannot be told apart and stay.
    """
    names = docs.columns
    mine = docs.toDF(*[f"_{i}" for i in range(len(names))])
    doc, text = (f"_{names.index(c)}" for c in ("doc_id", "text"))
    first = ngram_join.representatives(docs)
    chosen = (F.col(doc) == F.col("doc_id")) & (F.xxhash64(text) == F.col("text_id"))
    rows = mine.join(first, chosen, "left_semi")
    # As JSON any column can be compared; the text is the same in all rows of a group.
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[c for c in mine.columns if c not in (doc, text)]))
    least = F.min_by(F.struct(*mine.columns), others).alias("row")
    named = rows.groupBy(doc, F.xxhash64(text).alias("text_id")).agg(least).select("row.*")
    return named.unionByName(mine.where(F.col(doc).isNull())).toDF(*names)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 200 bytes that start in two places."""
    return substrings.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, path, op09.END_ID, op09.CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("suffix_array_dedup", remove_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

# The classifier and the packing are not expressible in SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
