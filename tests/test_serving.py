"""JDBC operators against a recording stand-in; no database is started."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from tickhouse.sources import serving

URL, PROPS = "jdbc:none", {"user": "u"}


@pytest.fixture
def database(spark, monkeypatch):
    """Tables as lists of rows, with the few statements the operators send."""
    tables, log = {}, []

    def write(self, url, table, mode=None, properties=None):
        assert (url, properties) == (URL, PROPS)
        # The writer keeps its frame to itself; a temporary Parquet folder gives the rows back.
        df = self._df
        log.append((mode, table))
        new = [r.asDict() for r in df.collect()]
        tables[table] = new if mode == "overwrite" else tables.get(table, []) + new

    def read(self, url, table, properties=None):
        log.append(("read", table))
        newest = re.fullmatch(r"\(select max\((\w+)\) as newest from (\w+)\) q", table)
        if newest:
            values = [r[newest[1]] for r in tables[newest[2]]]
            return spark.createDataFrame([(max(values, default=None),)], "newest timestamp")
        done = re.fullmatch(r"\(select ([\w, ]+) from (\w+) where batch_id = (\d+)\) q", table)
        names = done[1].split(", ")
        found = [
            tuple(r[n] for n in names)
            for r in tables.get(done[2], []) if r["batch_id"] == int(done[3])
        ]
        return spark.createDataFrame(found, ", ".join(f"{n} long" for n in names))

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    return tables, log


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long").withColumn(
        "t", F.timestamp_seconds("id")
    )


def test_overwrite_skips_an_empty_frame(spark, database):
    tables, log = database
    assert serving.jdbc_overwrite(frame(spark, 1, 2), URL, "prices", PROPS)
    assert not serving.jdbc_overwrite(frame(spark, 1).limit(0), URL, "prices", PROPS)
    assert [r["id"] for r in tables["prices"]] == [1, 2] and len(log) == 1


def test_incremental_append(spark, database):
    tables, log = database

    def append(*ids, **more):
        return serving.jdbc_incremental_append(frame(spark, *ids), URL, "hist", "t", PROPS, **more)

    assert append(1, 2, table_exists=False)  # no table: a full load, without asking it
    assert append(1, 2, 3)
    assert not append(1, 2, 3)
    assert [r["id"] for r in tables["hist"]] == [1, 2, 3]
    tables["hist"].clear()
    assert append(1, 2) and len(tables["hist"]) == 2
    assert ("read", "(select max(t) as newest from hist) q") in log


def test_a_failed_read_is_not_a_missing_table(spark, monkeypatch):
    def broken(*_, **__):
        raise OSError("connection lost")

    monkeypatch.setattr(DataFrameReader, "jdbc", broken)
    with pytest.raises(OSError):
        serving.jdbc_incremental_append(frame(spark, 1), URL, "hist", "t", PROPS)


def test_a_replayed_batch_adds_only_what_is_missing(spark, database):
    tables, _ = database
    serving.append_batch(frame(spark, 1, 2), 7, URL, "news", ["id"], PROPS)
    del tables["news"][1]  # the first try was lost half-way
    serving.append_batch(frame(spark, 1, 2), 7, URL, "news", ["id"], PROPS)
    serving.append_batch(frame(spark, 1, 2), 7, URL, "news", ["id"], PROPS)
    serving.append_batch(frame(spark, 3), 8, URL, "news", ["id"], PROPS)
    assert sorted(r["id"] for r in tables["news"]) == [1, 2, 3]
    assert {r["batch_id"] for r in tables["news"]} == {7, 8}


def test_stream_append(spark, database, folder):
    tables, _ = database
    for i in range(3):
        frame(spark, i).coalesce(1).write.mode("append").parquet(folder("in"))
    stream = (
        spark.readStream.schema("id long, t timestamp").option("maxFilesPerTrigger", 1)
        .parquet(folder("in"))
    )
    for _ in (1, 2):
        serving.jdbc_stream_append(
            stream, URL, "social", folder("ckpt"), ["id"], PROPS
        ).awaitTermination()
    assert sorted(r["id"] for r in tables["social"]) == [0, 1, 2]


def test_query_is_sent_as_a_subquery(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, url, table, properties=None: seen.append(table)
    )
    serving.jdbc_query(spark, URL, "select label, count(*) as n from s group by label", PROPS)
    assert seen == ["(select label, count(*) as n from s group by label) q"]
