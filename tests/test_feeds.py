"""Feeds written for the streams: files grow in number, not in size, and batches stay the same."""

from pyspark.sql import functions as F

from tickhouse import schemas
from tickhouse.sources import lake
from workload import feeds, tables

SF = "/root/testdata/sf0.001"


def sizes(spark, path, what):
    """``what`` of the rows of every file."""
    found = spark.read.parquet(path).groupBy(F.input_file_name()).agg(what.alias("n")).collect()
    return [row.n for row in found]


def test_a_feed_has_files_by_its_size_and_three_batches(spark, monkeypatch):
    monkeypatch.setattr(feeds, "FEED_FILE_BYTES", 1000, raising=False)
    land, sources = feeds.streams.bronze_stream, []

    def spy(session, source, *rest):
        sources.append(source)
        return land(session, source, *rest)

    monkeypatch.setattr(feeds.streams, "bronze_stream", spy)
    sent = spark.range(300).select("id", F.repeat(F.lit("x"), 100).alias("raw_value"))
    got = feeds.landed_feed(tables.Tables(spark, SF), sent, "feed").select("offset", "ingested_at").collect()
    assert sorted(row.offset for row in got) == list(range(300))
    written = sizes(spark, sources[0]["path"], F.sum(F.octet_length("value")))
    assert sum(written) == 30000 and max(written) <= 2000
    assert len({row.ingested_at for row in got}) == 3


def test_messages_have_files_by_their_number_and_arrive_in_order(spark, monkeypatch):
    monkeypatch.setattr(tables, "MESSAGES_PER_FILE", 50, raising=False)
    t = tables.Tables(spark, SF)
    sent = t.messages()
    files = sizes(spark, t.message_source()["path"], F.count("*"))
    assert sum(files) == sent.count() and max(files) <= 100
    landed = lake.read_lake(spark, feeds.landed(t), schemas.ENVELOPE)
    assert landed.select("offset").exceptAll(sent.select("offset")).isEmpty()
    ends = landed.groupBy("ingested_at").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    parts = ends.orderBy("ingested_at").collect()
    assert len(parts) == 3
    assert all(before.high < after.low for before, after in zip(parts, parts[1:]))


def test_messages_without_a_position_are_kept(spark, monkeypatch):
    t = tables.Tables(spark, SF)
    sent = t.messages().withColumn("offset", F.expr("nullif(offset % 4, 0)"))
    monkeypatch.setattr(t, "messages", lambda: sent)
    assert spark.read.parquet(t.message_source()["path"]).exceptAll(sent).isEmpty()
    assert spark.read.parquet(t.message_source()["path"]).count() == sent.count()
