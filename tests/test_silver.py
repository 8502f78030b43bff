"""Parsing, quality rules and their edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickhouse.functions import temporal, text
from tickhouse.operators import silver
from tickhouse.sources import files, messages

NOON = 1777636800000  # 2026-05-01T12:00:00Z


def envelope(spark, payloads):
    data = [(p, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(data, "raw_value string, offset long").withColumns(
        {"kafka_timestamp": F.timestamp_seconds("offset"), "ingested_at": F.timestamp_seconds(F.lit(0))}
    )


def tick(symbol='"BTC"', price=1.0, volume=2.0, at=NOON):
    return f'{{"symbol": {symbol}, "price": {price}, "volume_24h": {volume}, "timestamp": {at}}}'


BAD = [
    (tick(symbol="null"), "symbol_missing"),
    (tick(price="null"), "price_missing"),
    (tick(at="null"), "event_time_missing"),
    (tick(at=9223372036854775807), "event_time_missing"),
    (tick(price=0), "price_not_positive"),
    (tick(price=-3), "price_not_positive"),
    (tick(volume=0), "volume_not_positive"),
    (tick(volume="null"), "volume_not_positive"),
    ("{not json", "symbol_missing"),
    ("", "symbol_missing"),
]


def test_bad_ticks_go_to_quarantine(spark):
    bronze = envelope(spark, [tick()] + [text for text, _ in BAD])
    assert silver.silver_ticks(bronze).count() == 1
    rejected = silver.quarantine(silver.parse_ticks(bronze), silver.tick_rules())
    reasons = [r.reject_reason for r in rejected.orderBy("offset").collect()]
    assert reasons == [reason for _, reason in BAD]


def test_ticks_of_one_second_are_kept_apart(spark):
    bronze = envelope(spark, [tick(price=1.0), tick(price=2.0, at=NOON + 250), tick(price=3.0, at=NOON + 250)])
    exact = silver.silver_ticks(bronze, dedup=True)
    assert [r.price for r in exact.orderBy("event_time").collect()] == [1.0, 3.0]
    whole = silver.silver_ticks(bronze, truncate_to="second", dedup=True).collect()
    assert [(r.price, r.event_time) for r in whole] == [(3.0, datetime(2026, 5, 1, 12))]
    assert (whole[0].year, whole[0].month, whole[0].day, whole[0].hour) == (2026, 5, 1, 12)


def test_news_and_posts(spark):
    news = spark.createDataFrame(
        [("s", "t", "2026-05-01T12:00:00Z"), ("s", None, "2026-05-01T12:00:00Z"), ("s", "", "soon")],
        "source string, title string, published_at string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("description", "url", "content")})
    news = news.withColumn("ingested_at", F.current_timestamp())
    got = silver.silver_news(news).select("title", "published_at").collect()
    assert [tuple(r) for r in got] == [("t", datetime(2026, 5, 1, 12)), ("", None)]
    posts = spark.createDataFrame(
        [("a", "t", None), ("b", None, "x"), ("c", None, None), ("b", None, "x")],
        "post_id string, title string, text string",
    ).withColumns(
        {
            "subreddit": F.lit("r"), "score": F.lit(0), "num_comments": F.lit(0),
            "created_utc": F.lit(1777636800).cast("long"), "url": F.lit("u"), "type": F.lit("t"),
            "ingested_at": F.current_timestamp(),
        }
    )
    assert sorted(r.post_id for r in silver.silver_social(posts).collect()) == ["a", "b", "b"]
    assert sorted(r.post_id for r in silver.silver_social(posts, ("post_id",)).collect()) == ["a", "b"]


def test_title_rules(spark):
    titles = {
        "Ethereum vs Bitcoin": ("BTC", "BTC"),
        "A new method": ("ETH", "Other"),
        "ETH, up": ("ETH", "ETH"),
        "Shiba and XRP": ("XRP", "XRP"),
        "Nothing": ("Other", "Other"),
    }
    df = spark.createDataFrame([(k,) for k in titles], "title string")
    got = df.select(
        "title",
        text.symbol_from_title(F.col("title")).alias("a"),
        text.symbol_from_title(F.col("title"), mode="word").alias("b"),
    ).collect()
    assert {r.title: (r.a, r.b) for r in got} == titles
    with pytest.raises(ValueError):
        text.mentions(F.col("title"), ["x"], "fuzzy")


def test_symbols_and_words(spark):
    df = spark.createDataFrame([("btcusdt",), ("USDT",), ("ETH",), (None,)], "s string")
    got = [r[0] for r in df.select(text.normalize_symbol(F.col("s"))).collect()]
    assert got == ["BTC", "USDT", "ETH", None]
    line = spark.createDataFrame([("Über-Größe, 2x_y!",)], "s string")
    assert line.select(text.words(F.col("s"))).first()[0] == ["über", "größe", "2x_y"]


def test_times(spark):
    df = spark.range(1).select(
        temporal.epoch_millis(F.lit(NOON + 999)).alias("a"),
        temporal.epoch_millis(F.lit(NOON + 999), "second").alias("b"),
        temporal.epoch_seconds(F.lit(NOON // 1000)).alias("c"),
        temporal.iso_timestamp(F.lit("2026-05-01T12:00:00Z")).alias("d"),
        temporal.iso_timestamp(F.lit("soon")).alias("e"),
    )
    r = df.first()
    noon = datetime(2026, 5, 1, 12)
    assert (r.a.microsecond, r.b, r.c, r.d, r.e) == (999000, noon, noon, noon, None)


def kline(at, n=12):
    items = [at, "1.5", "2.5", "0.5", "2.0", "10", at + 59999, "20", 7, "1", "2", "0", "99"]
    return "[" + ", ".join(f'"{x}"' if isinstance(x, str) else str(x) for x in items[:n]) + "]"


@pytest.mark.parametrize("gap", ["", " ", "\n  "])
def test_kline_files(spark, tmp_path, gap):
    body = f",{gap}".join([kline(NOON), kline(NOON + 60000, 11), kline(NOON + 120000, 13)])
    (tmp_path / "btcusdt_raw_klines.json").write_text(f"[{gap}{body}{gap}]")
    (tmp_path / "ethusdt_raw_klines.json").write_text(f"[{kline(NOON)}]")
    (tmp_path / "adausdt_raw_klines.json").write_text("[]")
    df = files.read_kline_files(spark, str(tmp_path))
    got = rows(df.select("symbol", "open_time", "close", "number_of_trades", "taker_buy_quote_asset_volume"))
    assert [r[0] for r in got] == ["BTCUSDT"] * 3 + ["ETHUSDT"]
    assert {r[1].minute for r in got} == {0, 1, 2}
    assert {r[2:] for r in got} == {(2.0, 7, 2.0)}


def test_a_large_kline_file_is_read_by_several_tasks(spark, tmp_path):
    body = ", ".join(kline(NOON + 60000 * i) for i in range(20000))
    (tmp_path / "btcusdt_raw_klines.json").write_text(f"[{body}]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
        df = files.read_kline_files(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        assert df.agg(F.count("*"), F.count_distinct("open_time"), F.sum("volume")).first() == (
            20000, 20000, 200000.0
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_article_files(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"news_{i}.json").write_text(
            '[\n {"source": {"id": null, "name": "n"}, "title": "t%d",\n "publishedAt": '
            '"2026-05-01T12:00:00Z"},\n {"title": "u%d"}\n]' % (i, i)
        )
    got = files.read_articles(spark, f"{tmp_path}/*.json")
    assert sorted(r.title for r in got.collect()) == ["t1", "t2", "u1", "u2"]
    assert got.filter("source = 'n'").count() == 2


def test_payload_defaults(spark):
    raw = spark.createDataFrame(
        [('{"s": "BTCUSDT", "E": 5}',), ('{"s": "ETHUSDT", "c": "2.5", "v": "9", "E": 6}',)],
        "raw_value string",
    )
    got = rows(messages.normalize_payload(raw, "ticker"))
    assert got == [("BTCUSDT", 0.0, 0.0, 5, "binance"), ("ETHUSDT", 2.5, 9.0, 6, "binance")]
    feed = spark.createDataFrame(
        [('{"feed": "f", "link": "http://x", "summary": "s"}',)], "raw_value string"
    )
    row = messages.normalize_payload(feed, "feed").first()
    assert (row.post_id, row.title, row.text, row.score, row.type) == (
        "http://x", "", "s", 0, "rss_opinion"
    )
    with pytest.raises(ValueError):
        messages.field_map("fax")


def test_payload_columns_match_the_declared_schemas(spark):
    raw = spark.createDataFrame([("{}",)], "raw_value string")
    for source, ddl in messages.PAYLOADS.items():
        declared = [part.split()[0] for part in ddl.split(", ")]
        assert messages.normalize_payload(raw, source).columns == declared
