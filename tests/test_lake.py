"""Upserts, crash recovery, compaction, incremental extraction, exports."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickhouse.operators import incremental
from tickhouse.operators.dedup import dedup_keys
from tickhouse.sources import files, lake

SCHEMA = "symbol string, at int, day int, price double, seen int"


def table(spark, path, parts=("day",)):
    return lake.LakeTable(spark, path, ["symbol", "at"], parts, [F.desc("seen")])


def make(spark, data):
    return spark.createDataFrame([(s, at, at // 10, p, n) for s, at, p, n in data], SCHEMA)


def stamps(path):
    return {
        os.path.join(root, name): os.stat(os.path.join(root, name)).st_mtime_ns
        for root, _, names in os.walk(path)
        for name in names
        if name.startswith("part-")
    }


@pytest.mark.parametrize("parts", [("day",), ()])
def test_upsert_updates_and_inserts(spark, folder, parts):
    t = table(spark, folder("t"), parts)
    t.upsert(make(spark, [("A", 1, 1.0, 1), ("A", 11, 2.0, 1), ("B", 1, 3.0, 1)]))
    t.upsert(make(spark, [("A", 1, 9.0, 2), ("A", 1, 8.0, 1), ("C", 25, 5.0, 1)]))
    got = rows(t.read().select("symbol", "at", "price"))
    assert got == [("A", 1, 9.0), ("A", 11, 2.0), ("B", 1, 3.0), ("C", 25, 5.0)]


def test_upsert_of_itself_changes_nothing(spark, folder):
    t = table(spark, folder("t"))
    data = make(spark, [("A", i, float(i), 1) for i in range(50)])
    t.upsert(data)
    before = rows(t.read().select("symbol", "at", "price", "seen"))
    t.upsert(data)
    assert rows(t.read().select("symbol", "at", "price", "seen")) == before


def test_only_touched_partitions_are_rewritten(spark, folder):
    t = table(spark, folder("t"))
    t.upsert(make(spark, [("A", i, float(i), 1) for i in range(50)]))
    before = stamps(t.path)
    t.upsert(make(spark, [("A", 23, -1.0, 2)]))
    after = stamps(t.path)
    changed = {p.split("day=")[1][0] for p in set(before) ^ set(after)}
    assert changed == {"2"}
    assert t.read().count() == 50


def test_new_keys_are_appended(spark, folder):
    t = table(spark, folder("t"))
    t.upsert(make(spark, [("A", i, float(i), 1) for i in range(50)]))
    before = stamps(t.path)
    t.upsert(make(spark, [("B", 3, 1.0, 1), ("B", 70, 1.0, 1)]))
    assert before.items() <= stamps(t.path).items()  # no file was rewritten
    t.upsert(make(spark, [("B", 3, 2.0, 2), ("C", 3, 2.0, 2), ("C", 44, 2.0, 2)]))
    kept = [p for p in before if p in stamps(t.path)]
    assert {p.split("day=")[1][0] for p in kept} == {"1", "2", "3", "4"}
    assert t.read().count() == 54 and t.read().filter("seen = 2").count() == 3


def test_repeated_history_rewrites_only_what_changed(spark, folder):
    t = table(spark, folder("t"))
    history = [("A", i, float(i), 1) for i in range(50)]
    t.upsert(make(spark, history))
    before = stamps(t.path)
    t.upsert(make(spark, history), compare=["price"])
    assert stamps(t.path) == before
    t.upsert(make(spark, history[:-1] + [("A", 49, 7.0, 1)]), compare=["price"])
    assert {p.split("day=")[1][0] for p in set(before) ^ set(stamps(t.path))} == {"4"}
    assert t.read().filter("at = 49").first().price == 7.0


@pytest.mark.parametrize("parts", [("day",), (), ("day", "part")])
def test_rows_without_a_place_are_returned_and_nothing_is_lost(spark, folder, parts):
    schema = "symbol string, at int, day int, part string, price double, seen int"
    t = table(spark, folder("t"), parts)
    t.upsert(spark.createDataFrame([("A", 1, 0, "x", 1.0, 1), ("B", 12, 1, "y", 2.0, 1)], schema))
    again = spark.createDataFrame(
        [("A", 1, 0, "x", 9.0, 2), (None, 3, 0, "x", 5.0, 2), ("C", 5, None, None, 6.0, 2),
         ("D", 7, 0, None, 7.0, 2)], schema,
    )
    for _ in range(2):
        rejected = t.upsert(again)
        why = {r.price: r.reject_reason for r in rejected.collect()}
        assert why[5.0] == "symbol_null"
        assert why.get(6.0) == ("day_null" if parts else None)
        assert why.get(7.0) == ("part_null" if "part" in parts else None)
        stored = [r.price for r in t.read().select("price").collect()]
        assert sorted(stored + list(why)) == [2.0, 5.0, 6.0, 7.0, 9.0]


def test_a_folder_without_a_marker_is_a_table(spark, folder):
    old = spark.sparkContext._jsc.hadoopConfiguration()
    for name, parts in (("a", ()), ("b", ("day",))):
        t = table(spark, folder(name), parts)
        old.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        try:
            t.append(make(spark, [("A", 1, 1.0, 1), ("A", 2, 2.0, 1)]))
        finally:
            old.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
        assert "_SUCCESS" not in os.listdir(t.path) and t.exists()
        t.upsert(make(spark, [("A", 3, 3.0, 1)]))
        assert t.read().count() == 3


def test_an_empty_or_missing_folder_is_no_table(spark, folder):
    t = table(spark, folder("t"))
    assert not t.exists()
    os.mkdir(t.path)
    open(os.path.join(t.path, "_SUCCESS"), "w").close()
    assert not t.exists()
    t.upsert(make(spark, [("A", 1, 1.0, 1)]))
    assert t.exists() and t.read().count() == 1


def test_reading_never_writes(spark, folder):
    t = table(spark, folder("t"))
    t.upsert(make(spark, [("A", 1, 1.0, 1)]))
    before = sorted(os.walk(folder("")))
    assert t.exists() and t.read().count() == 1
    assert sorted(os.walk(folder(""))) == before


def test_overwriting_from_itself(spark, folder):
    for name, parts in (("a", ()), ("b", ("day",))):
        t = table(spark, folder(name), parts)
        t.upsert(make(spark, [("A", i, float(i), 1) for i in range(30)]))
        t.overwrite(t.read().filter("at >= 15"))
        assert t.read().count() == 15


def test_compaction_leaves_well_packed_partitions_alone(spark, folder):
    path = folder("t")
    data = make(spark, [("A", i, float(i), 1) for i in range(20)])
    data.filter("day = 0").coalesce(1).write.partitionBy("day").parquet(path)
    for _ in range(4):
        data.filter("day = 1").coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    before = stamps(path)
    lake.compact(spark, path, ["day"])
    after = stamps(path)
    assert {p for p in before if "day=0" in p} == {p for p in after if "day=0" in p}
    assert sum("day=1" in p for p in after) == 1
    assert lake.read_lake(spark, path).count() == 50


def test_a_hot_partition_is_written_by_several_tasks(spark, folder):
    data = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1 << 20))
        lake.write_partitioned(data.repartition(8), folder("t"), "overwrite", ["day"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    per_day = [sum(f"day={d}/" in p for p in stamps(folder("t"))) for d in (0, 7)]
    assert per_day[0] > 2 >= per_day[1]
    assert lake.read_lake(spark, folder("t")).count() == 200_000


def test_dedup_is_repeatable_without_an_order(spark):
    data = make(spark, [("A", 1, float(i), i) for i in range(20)])
    picks = {
        dedup_keys(data.repartition(n), ["symbol", "at"]).first().price for n in (1, 2, 3, 4)
    }
    assert len(picks) == 1


def test_new_rows(spark):
    source = make(spark, [("A", 1, 0.0, 0), ("A", 5, 0.0, 0), ("B", 2, 0.0, 0), ("C", 1, 0.0, 0)])
    source = source.withColumn("t", F.timestamp_seconds("at"))
    target = source.filter("(symbol = 'A' and at = 1) or (symbol = 'B' and at = 2)")

    def got(df):
        return [(r.symbol, r.at) for r in df.orderBy("symbol", "at").collect()]

    assert got(incremental.new_rows(source, target, "t")) == [("A", 5)]
    assert got(incremental.new_rows(source, target, "t", "symbol")) == [("A", 5), ("C", 1)]
    assert incremental.new_rows(source, target.limit(0), "t").count() == 4
    assert incremental.new_rows(source, source, "t").count() == 0


def test_csv_export(spark, folder):
    df = spark.createDataFrame(
        [('say "hi"', 1, None, ["x"]), (None, 2, 2.5, None), ("a,b\nc", 3, 0.1, [])],
        "name string, n int, v double, tags array<string>",
    ).coalesce(1)
    files.export_csv(df, folder("c"), {"name": "Coin", "v": "Value", "tags": "Tags"})
    part = next(p for p in stamps(folder("c")))
    with open(part) as f:
        assert f.read() == (
            '"Coin","Value","Tags"\n"say ""hi""","","[""x""]"\n"","2.5",""\n"a,b\nc","0.1","[]"\n'
        )


def test_json_export(spark, folder):
    df = spark.createDataFrame([("a", None, (1, 2))], "n string, v double, s struct<x:int,y:int>")
    df = df.coalesce(1)
    files.export_json(df, folder("j"), {"s": "S", "v": "V"})
    with open(next(p for p in stamps(folder("j")))) as f:
        assert json.loads(f.read()) == {"S": {"x": 1, "y": 2}, "V": None}
