"""Duplicates by suspects: the plain result, whatever the pages and runs, and few shuffled rows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickhouse.operators import quality


@pytest.fixture(scope="module")
def keyed(spark):
    """Unique keys, a hot key, pairs, null keys and zeros of either sign."""
    unique = spark.range(20000).select(F.col("id").cast("string").alias("a"), F.col("id").cast("double").alias("b"))
    hot = spark.range(8000).select(F.lit("hot").alias("a"), F.lit(1.5).alias("b"))
    pairs = spark.range(300).select((F.col("id") * 7).cast("string").alias("a"), (F.col("id") * 7.0).alias("b"))
    odd = spark.sql(
        "select * from values (null, null), (null, null), ('z', 0d), ('z', -0d), ('y', null), (null, 2d), "
        "('n', double('nan')), ('n', double('nan')) as t(a, b)"
    )
    return unique.unionByName(hot).unionByName(pairs).unionByName(odd).repartition(5)


@pytest.mark.parametrize("page_keys, run_keys", [(1 << 20, 1 << 22), (100, 1000), (1, 1)])
def test_suspects_give_the_plain_duplicates(keyed, page_keys, run_keys):
    found = quality.unique(keyed, ["a", "b"], page_keys, run_keys)
    texts = [F.col(name).cast("string") for name in ("a", "b", "cnt")]
    assert rows(found.select(*texts)) == rows(quality.repeated(keyed, ["a", "b"]).select(*texts))
    assert found.count() == 304


def test_empty_and_unique_tables_have_no_duplicates(spark):
    assert quality.unique(spark.range(0), ["id"]).isEmpty()
    assert quality.unique(spark.range(1000), ["id"]).isEmpty()


def test_suspects_are_about_as_many_as_duplicates(keyed):
    suspects = quality.suspect_hashes(keyed, ["a", "b"], 1000, 5000)
    assert suspects.count() == 304
    # Shuffled: a row per page of every run, not one per key.
    plan = suspects._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(page") == 1
