"""Streams give what the batch operators give, however the input is cut and ordered."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickhouse import schemas
from tickhouse.operators import accounts, bars, dedup, silver
from tickhouse.sources import lake, messages
from tickhouse.streaming import late
from tickhouse.streaming import ticks as streams

CATCH_UP = {"availableNow": True}
START = datetime(2026, 5, 1)
DAYS = ("year", "month", "day")
SPLITS = [(1, False), (3, False), (7, True)]


def tick_rows(n=400):
    rng = random.Random(3)
    out = []
    for i in range(n):
        at = START + timedelta(minutes=17 * i, milliseconds=rng.randrange(1000))
        symbol = "HOT" if i % 3 == 0 else rng.choice(["A", "B", "C"])
        price = rng.choice([0.0, -1.0]) if i % 50 == 0 else round(rng.uniform(1, 90), 2)
        out.append((i, symbol, price, float(i), at))
    return out


def as_messages(spark, data):
    df = spark.createDataFrame(
        data, "offset long, symbol string, price double, volume_24h double, timestamp timestamp"
    )
    payload = F.to_json(
        F.struct("symbol", "price", "volume_24h", F.unix_millis("timestamp").alias("timestamp"))
    )
    return df.select(
        F.encode("symbol", "UTF-8").alias("key"), F.encode(payload, "UTF-8").alias("value"),
        F.lit("prices").alias("topic"), F.lit(0).alias("partition"), "offset", "timestamp",
    )


def write_files(spark, data, path, files, shuffled):
    """The ticks as so many files; shuffled, old ones may arrive after new ones."""
    data = list(data)
    if shuffled:
        random.Random(files).shuffle(data)
    size = -(-len(data) // files)
    for i in range(files):
        part = data[i * size : (i + 1) * size]
        as_messages(spark, part).coalesce(1).write.mode("append").parquet(path)
    return {"format": "parquet", "path": path, "maxFilesPerTrigger": "1"}


def bronze(spark, source):
    return messages.bronze_envelope(messages.read_message_stream(spark, source, "prices"))


def batch_ticks(spark, data):
    raw = messages.bronze_envelope(as_messages(spark, data))
    return silver.silver_ticks(raw, dedup=True, parts=DAYS)


def silver_table(spark, path):
    return lake.LakeTable(spark, path, ["symbol", "event_time"], DAYS, [F.desc("offset")])


VALUES = ("symbol", "event_time", "price", "volume_24h")


@pytest.mark.parametrize("files,shuffled", SPLITS)
def test_silver(spark, folder, files, shuffled):
    data = tick_rows()
    source = write_files(spark, data, folder("in"), files, shuffled)
    table = silver_table(spark, folder("silver"))
    latest = lake.LakeTable(spark, folder("latest"), ["symbol"])
    for checkpoint in ("ckpt", "replay"):  # the second run sees every message again
        streams.silver_stream(
            bronze(spark, source), table, folder(checkpoint), CATCH_UP, parts=DAYS, latest=latest
        ).awaitTermination()
        want = batch_ticks(spark, data)
        assert rows(table.read().select(*VALUES)) == rows(want.select(*VALUES))
        newest = bars.latest_prices(silver.stg_prices(want))
        assert rows(latest.read().select(*newest.columns)) == rows(newest)


def test_bronze_and_resume(spark, folder):
    data = tick_rows(60)
    source = write_files(spark, data[:40], folder("in"), 2, False)
    for upto in (40, 60):
        streams.bronze_stream(
            spark, source, folder("bronze"), folder("ckpt"), "prices", "earliest", CATCH_UP, "land"
        ).awaitTermination()
        landed = lake.read_lake(spark, folder("bronze"), schemas.ENVELOPE)
        assert sorted(r.offset for r in landed.collect()) == list(range(upto))
        if upto == 40:
            write_files(spark, data[40:], folder("in"), 1, False)
    assert landed.filter("ingested_at is null or raw_value is null").count() == 0


def test_topics_are_kept_apart(spark, folder):
    source = write_files(spark, tick_rows(5), folder("in"), 1, False)
    stream = messages.read_message_stream(spark, source, "news")
    lake.append_stream(stream, folder("out"), folder("ckpt"), CATCH_UP).awaitTermination()
    assert lake.read_lake(spark, folder("out"), messages.RAW_MESSAGE).count() == 0


@pytest.mark.parametrize("spread", [None, "offset"])
@pytest.mark.parametrize("files", [1, 5])
def test_dedup(spark, folder, files, spread):
    data = tick_rows(100)
    copies = [(i + 1000 * c, *rest) for c in range(4) for i, *rest in data]
    source = write_files(spark, copies, folder("in"), files, True)
    parsed = silver.parse_ticks(bronze(spark, source))
    once = streams.stream_dedup(
        parsed, ["symbol", "event_time"], "event_time", "10 days", spread_by=spread
    )
    lake.append_stream(
        once.select("symbol", "event_time", "price"), folder("out"), folder("ckpt"), CATCH_UP
    ).awaitTermination()
    want = silver.parse_ticks(messages.bronze_envelope(as_messages(spark, data)))
    got = spark.read.parquet(folder("out"))
    assert rows(got) == rows(want.select("symbol", "event_time", "price"))


def bars_of(spark, source, folder, delay):
    parsed = silver.passing(silver.parse_ticks(bronze(spark, source)), silver.tick_rules())
    table = lake.LakeTable(spark, folder("bars"), ["symbol", "date"], ["date"])
    daily = streams.stream_daily_bars(parsed.withColumnRenamed("volume_24h", "volume"), delay)
    streams.keep_bars(daily, table, folder("ckpt"), CATCH_UP).awaitTermination()
    return table.read()


@pytest.mark.parametrize("files,shuffled", SPLITS)
def test_daily_bars(spark, folder, files, shuffled):
    data = tick_rows()
    source = write_files(spark, data, folder("in"), files, shuffled)
    got = bars_of(spark, source, folder, "30 days")
    ticks = silver.stg_prices(batch_ticks(spark, data))
    days = [r.d for r in ticks.select(F.to_date("event_time").alias("d")).distinct().collect()]
    want = [
        row for d in days for row in rows(
            bars.intraday_ohlcv(ticks, F.lit(d)).select(*bars.BAR)
        )
    ]
    assert rows(got.select(*bars.BAR)) == sorted(want, key=lambda r: tuple(map(repr, r)))


def test_late_ticks_miss_the_bar_but_reach_silver(spark, folder):
    day = timedelta(days=1)
    early = [(0, "A", 5.0, 1.0, START + day * 10), (1, "A", 6.0, 1.0, START + day * 11)]
    late = [(2, "A", 9.0, 1.0, START), (3, "A", 7.0, 1.0, START + day * 11)]
    source = write_files(spark, early, folder("in"), 1, False)
    for _ in (1, 2):
        got = bars_of(spark, source, folder, "1 day")
        table = silver_table(spark, folder("silver"))
        streams.silver_stream(
            bronze(spark, source), table, folder("ckpt2"), CATCH_UP, parts=DAYS
        ).awaitTermination()
        write_files(spark, late, folder("in"), 1, False)
        late = [(4, "A", 8.0, 1.0, START + day * 11)]
    assert [(r.date.day, r.high_price) for r in got.orderBy("date").collect()] == [(11, 5.0), (12, 7.0)]
    assert table.read().count() == 4 - 1  # both ticks of the last day have one time
    assert table.read().filter(F.col("event_time") < F.lit(START + day)).count() == 1


@pytest.mark.parametrize("files,shuffled", SPLITS)
def test_alerts_fire_once(spark, folder, files, shuffled):
    data = tick_rows()
    source = write_files(spark, data, folder("in"), files, shuffled)
    alerts = spark.createDataFrame(
        [
            (i, 1, s, c, t, i != 3)
            for i, (s, c, t) in enumerate(
                (s, c, t) for s in ("HOT", "A", "ZZZ") for c in ("above", "below")
                for t in (0.5, 2.0, 45.0, 88.0, 95.0)
            )
        ],
        "id long, user_id long, symbol string, condition string, threshold double, is_active boolean",
    )
    parsed = silver.parse_ticks(bronze(spark, source))
    streams.stream_alerts(
        parsed, lambda: alerts, folder("fired"), folder("ckpt"), trigger=CATCH_UP
    ).awaitTermination()
    fired = [r.id for r in spark.read.parquet(folder("fired")).collect()]
    ticks = silver.parse_ticks(messages.bronze_envelope(as_messages(spark, data)))
    want = accounts.evaluate_alerts(
        alerts, streams.batch_extremes(ticks), "high_price", "low_price"
    )
    assert sorted(fired) == sorted(r.id for r in want.collect()) and len(fired) > 5


def test_an_alert_fires_again_after_rearming(spark, folder):
    schema = "id long, user_id long, symbol string, condition string, threshold double, is_active boolean"
    active = iter([True, True, False, True, True])
    fired = []
    for k in range(5):
        data = [(k, "A", 50.0, 1.0, START + timedelta(hours=k))]
        source = write_files(spark, data, folder("in"), 1, False)
        alerts = spark.createDataFrame([(1, 1, "A", "above", 40.0, next(active))], schema)
        streams.stream_alerts(
            silver.parse_ticks(bronze(spark, source)), lambda alerts=alerts: alerts, folder("fired"),
            folder("ckpt"), trigger=CATCH_UP,
        ).awaitTermination()
        fired.append(spark.read.parquet(folder("fired")).count())
    assert fired == [1, 1, 1, 2, 2]
    assert spark.read.parquet(folder("fired_latch")).count() == 1


def test_ties_in_time_take_price_and_volume_of_one_tick(spark, folder):
    at = START + timedelta(hours=3)
    data = [(k, "A", p, v, at) for k, (p, v) in enumerate([(5.0, 9.0), (7.0, 1.0), (6.0, 4.0)])]
    source = write_files(spark, data, folder("in"), 1, False)
    bar = bars_of(spark, source, folder, "1 day").first()
    assert (bar.open_price, bar.close_price, bar.total_volume) == (5.0, 6.0, 4.0)


def test_alerts_by_last_price(spark, folder):
    data = [(i, "A", p, 1.0, START + timedelta(hours=i)) for i, p in enumerate([5.0, 50.0, 20.0])]
    source = write_files(spark, data, folder("in"), 1, False)
    alerts = spark.createDataFrame(
        [(1, 1, "A", "above", 40.0, True), (2, 1, "A", "above", 20.0, True)],
        "id long, user_id long, symbol string, condition string, threshold double, is_active boolean",
    )
    streams.stream_alerts(
        silver.parse_ticks(bronze(spark, source)), lambda: alerts, folder("fired"), folder("ckpt"),
        look_at="last", trigger=CATCH_UP,
    ).awaitTermination()
    assert [r.id for r in spark.read.parquet(folder("fired")).collect()] == [2]


def test_hour_bars_roll_up_to_the_tick_bars(spark):
    """Daily bars of hourly candles are the daily bars of the ticks themselves."""
    ticks = dedup.dedup_keys(
        silver.stg_prices(batch_ticks(spark, tick_rows())), ["symbol", "event_time"]
    )
    def candles(grain):
        return ticks.groupBy("symbol", F.date_trunc(grain, "event_time").alias("open_time")).agg(
            F.min_by("price", "event_time").alias("open"), F.max("price").alias("high"),
            F.min("price").alias("low"), F.max_by("price", "event_time").alias("close"),
            F.sum("volume").alias("volume"),
        )

    order = ["symbol", "date", "open_price", "high_price", "low_price", "close_price", "total_volume"]
    assert rows(bars.daily_ohlcv(candles("hour")).select(*order)) == rows(
        bars.daily_ohlcv(candles("day")).select(*order)
    )


def test_positions_of_a_replay(spark, folder):
    data = tick_rows(60)
    source = write_files(spark, data[20:40], folder("in"), 2, False)

    def offsets(starting, name, **options):
        raw = messages.read_message_stream(
            spark, source, "prices", starting, positions=folder(f"{name}-positions"), **options
        )
        lake.append_stream(raw, folder(f"{name}-out"), folder(f"{name}-ckpt"), CATCH_UP).awaitTermination()
        read = spark.read.schema(messages.RAW_MESSAGE).parquet(folder(f"{name}-out"))
        return sorted(r.offset for r in read.collect())

    assert offsets("earliest", "all") == list(range(20, 40))
    assert offsets("latest", "new") == []
    assert offsets({0: 30}, "given") == list(range(30, 40))
    assert offsets({0: 50}, "later") == []
    with pytest.raises(ValueError, match="lost"):
        offsets({0: 10}, "lost", fail_on_data_loss=True)
    with pytest.raises(ValueError, match="position"):
        offsets("first", "unknown")
    write_files(spark, data[40:], folder("in"), 1, False)
    # Restarts read what is new, once, from the positions of the first start.
    for _ in range(2):
        assert offsets("earliest", "all") == list(range(20, 60))
        assert offsets("latest", "new") == list(range(40, 60))
        assert offsets({0: 30}, "given") == list(range(30, 60))
        assert offsets({0: 50}, "later") == list(range(50, 60))
    assert messages.offset_gaps(as_messages(spark, data), slice_size=7).count() == 0
    some = as_messages(spark, data).filter("offset not in (7, 13, 14, 15) and offset > 2")
    gaps = messages.offset_gaps(some, slice_size=7).select("after", "before", "missing")
    assert rows(gaps) == [(12, 16, 3), (6, 8, 1)]


def test_late_ticks_are_listed_and_reach_their_bars(spark, folder):
    data = [row for row in tick_rows(300) if row[2] > 0]
    ordered = [*data[:100], *data[150:], *data[100:150]]
    source = None
    for k in range(0, len(ordered), 60):
        source = write_files(spark, ordered[k : k + 60], folder("in"), 1, False)
        parsed = silver.parse_ticks(bronze(spark, source)).withColumnRenamed("volume_24h", "volume")
        late.keep_bars_and_late(parsed, folder("bars"), folder("ckpt"), "1 hour", CATCH_UP).awaitTermination()
    states, behind, marks = late.tables(spark, folder("bars"))
    ticks = silver.stg_prices(batch_ticks(spark, data))
    want = late.bars_of(late.bar_states(ticks.withColumn("offset", F.lit(0).cast("long"))))
    assert rows(late.bars_of(states.read())) == rows(want)
    found = {r.offset: r.late_by_ms for r in behind.read().collect()}
    newest, expected = None, {}
    for k in range(0, len(ordered), 60):
        part = ordered[k : k + 60]
        for offset, _, _, _, at in part:
            if newest and newest - at > timedelta(hours=1):
                expected[offset] = (newest - at) // timedelta(milliseconds=1)
        newest = max([r[4] for r in part] + ([newest] if newest else []))
    assert found == expected and len(found) >= 50
    # A batch that is repeated changes nothing.
    before = rows(states.read())
    states.upsert(late.merge_states(states.read(), states.read()))
    assert rows(states.read()) == before
