"""Batch files: candle dumps, article backups, and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.functions import temporal
from tickhouse.functions.numeric import to_double, to_long
from tickhouse.schemas import KLINE_FIELDS

# ".../btcusdt_raw_klines.json" -> "btcusdt"
SYMBOL_IN_PATH = r"([^/_]+)_[^/]*\.json$"
ARTICLE = (
    "source struct<id string, name string>, author string, title string, description string, "
    "url string, urlToImage string, publishedAt string, content string"
)


def read_kline_files(
    spark: SparkSession, path: str, symbol_pattern: str = SYMBOL_IN_PATH
) -> DataFrame:
    """Candle dumps, one JSON array of 12-item arrays per symbol.

    A dump can be gigabytes on a single line. No candle field contains a bracket, so ``]`` is a
    safe record separator: the text source then splits one dump over many tasks and each record
    is one candle, instead of the whole file being one JSON value in one task. A record is parsed
    as the JSON array it is, so empty and null items keep their place; a record that is no JSON
    has only nulls. A path without a symbol gives a null symbol.
    """
    lines = (
        spark.read.option("lineSep", "]")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    record = F.concat(F.lit("["), F.substring_index("value", "[", -1), F.lit("]"))
    symbol = F.upper(F.regexp_extract("file", symbol_pattern, 1))
    raw = (
        lines.filter(F.contains("value", F.lit("[")))
        .select(F.from_json(record, "array<string>").alias("item"), "file")
        .filter(F.size("item").isNull() | (F.size("item") != 0))
        .select(
            F.nullif(symbol, F.lit("")).alias("symbol"),
            *[F.get("item", F.lit(i)).alias(name) for i, name in enumerate(KLINE_FIELDS)],
        )
    )
    doubles = (
        "open", "high", "low", "close", "volume", "quote_asset_volume",
        "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume",
    )
    typed: dict[str, Column] = {name: to_double(F.col(name)) for name in doubles}
    typed["number_of_trades"] = to_long(F.col("number_of_trades"))
    for name in ("open_time", "close_time"):
        typed[name] = temporal.epoch_millis(to_long(F.col(name)))
    columns = [typed[name].alias(name) for name in KLINE_FIELDS if name in typed]
    return raw.select(*columns, "symbol", F.current_timestamp().alias("ingested_at"))


def read_articles(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Article backups (one JSON array per poll, at most one page each) as one scan."""
    raw = spark.read.schema(ARTICLE).option("multiLine", True).json(path)
    return raw.select(
        F.col("source.name").alias("source"),
        "author",
        "title",
        "description",
        "url",
        temporal.iso_timestamp(F.col("publishedAt")).alias("published_at"),
        "content",
    )


def union_files(
    spark: SparkSession, paths: Sequence[str], schema: str, fmt: str = "parquet"
) -> DataFrame:
    """Many files as one scan; a union per file would grow the plan with the file count."""
    return spark.read.schema(schema).format(fmt).load(list(paths))


def _labelled(df: DataFrame, columns: Mapping[str, str] | None) -> DataFrame:
    if columns is None:
        return df
    return df.select(*[F.col(name).alias(label) for name, label in columns.items()])


def export_csv(df: DataFrame, path: str, columns: Mapping[str, str] | None = None) -> None:
    """CSV with every field quoted, quotes doubled, nulls as ``""`` and nested values as JSON.

    ``columns`` maps column names to header labels and fixes their order.
    """
    nested = (T.StructType, T.ArrayType, T.MapType)
    out = _labelled(df, columns)
    text = [
        F.to_json(F.col(f"`{field.name}`")).alias(field.name)
        if isinstance(field.dataType, nested)
        else F.col(f"`{field.name}`").cast("string").alias(field.name)
        for field in out.schema.fields
    ]
    (
        out.select(*[F.coalesce(col, F.lit("")).alias(field.name)
                     for col, field in zip(text, out.schema.fields)])
        .write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def export_json(df: DataFrame, path: str, columns: Mapping[str, str] | None = None) -> None:
    """JSON rows with the chosen columns under their labels; nested values stay nested."""
    (
        _labelled(df, columns)
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .json(path)
    )
