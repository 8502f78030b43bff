"""Alerts with latches in state against a replay row by row."""

from datetime import timedelta

import pytest

from test_streaming import CATCH_UP, SPLITS, START, bronze, tick_rows, write_files
from tickhouse.operators import silver
from tickhouse.streaming import alerts as stateful


def listed(spark, folder, rows):
    """Changes (id, symbol, condition, threshold, active, version) as one more file of the stream."""
    data = [(i, 7, s, c, t, on, v) for i, s, c, t, on, v in rows]
    spark.createDataFrame(data, stateful.CHANGES).coalesce(1).write.mode("append").parquet(folder("changes"))


def run(spark, folder, source, look_at="extremes", slices=4):
    stateful.keep_fired(
        silver.parse_ticks(bronze(spark, source)),
        spark.readStream.schema(stateful.CHANGES).parquet(folder("changes")),
        folder("fired"), folder("ckpt"), look_at, CATCH_UP, slices,
    ).awaitTermination()
    return sorted((r.id, r.current_price) for r in spark.read.schema(stateful.FIRED).parquet(folder("fired")).collect())


@pytest.mark.parametrize("files,shuffled", SPLITS)
def test_fires_once_per_latch(spark, folder, files, shuffled):
    source = write_files(spark, tick_rows(), folder("in"), files, shuffled)
    asked = [
        (i, s, c, t, i != 3, 1)
        for i, (s, c, t) in enumerate(
            (s, c, t) for s in ("HOT", "a", "ZZZ") for c in ("above", "below") for t in (0.5, 2.0, 45.0, 88.0, 95.0)
        )
    ]
    listed(spark, folder, asked)
    fired = run(spark, folder, source)
    prices = {}
    for _, symbol, price, _, _ in tick_rows():
        prices.setdefault(symbol, []).append(price)
    want = [
        i for i, s, c, t, on, _ in asked
        if on and any(p >= t if c == "above" else p <= t for p in prices.get(s.upper(), []))
    ]
    assert [i for i, _ in fired] == want and len(want) > 5


def test_rearming_and_restarts(spark, folder):
    """Each step is a run of its own from the same checkpoint; a replay by hand gives the counts."""
    steps = [
        ([(1, "A", "above", 40.0, True, 1)], 50.0, 1),
        ([], 60.0, 1),  # latched
        ([(1, "A", "above", 40.0, True, 2)], 55.0, 1),  # listed again, still latched
        ([(1, "A", "above", 40.0, False, 3)], 70.0, 1),  # off
        ([(1, "A", "above", 80.0, True, 4)], 70.0, 1),  # on, but higher
        ([], 80.0, 2),  # the threshold counts
        ([(1, "A", "above", 80.0, True, 6), (1, "A", "above", 80.0, False, 5)], 90.0, 3),  # off and on
    ]
    for k, (changes, price, want) in enumerate(steps):
        if changes:
            listed(spark, folder, changes)
        source = write_files(spark, [(k, "A", price, 1.0, START + timedelta(hours=k))], folder("in"), 1, False)
        assert len(run(spark, folder, source)) == want, k


def test_last_price(spark, folder):
    data = [(i, "A", p, 1.0, START + timedelta(hours=i)) for i, p in enumerate([5.0, 50.0, 20.0])]
    source = write_files(spark, data, folder("in"), 1, False)
    listed(spark, folder, [(1, "A", "above", 40.0, True, 1), (2, "A", "above", 20.0, True, 1)])
    assert run(spark, folder, source, "last") == [(2, 20.0)]
    with pytest.raises(ValueError):
        stateful.latched_alerts(None, None, "first")
