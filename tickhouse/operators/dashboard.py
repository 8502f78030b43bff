"""Dashboard and market-overview queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickhouse.functions import numeric, temporal
from tickhouse.functions.text import normalize_symbol, short_name
from tickhouse.operators.dedup import distinct_on, first_rows, latest_per_key
from tickhouse.operators.filters import symbol_filter


def with_global_count(
    df: DataFrame, predicate: Column, name: str, of: DataFrame | None = None
) -> DataFrame:
    """Add the number of rows of ``of`` (default: ``df``) that satisfy ``predicate``.

    A one-row subquery; a window without keys would move every row into one task.
    """
    counted = (of if of is not None else df).agg(F.count_if(predicate).alias("n"))
    return df.withColumn(name, F.coalesce(counted.scalar(), F.lit(0)))


def dashboard_stats(
    latest_prices: DataFrame,
    market_sentiment: DataFrame,
    min_price: float = 1.0,
    normalize: bool = False,
) -> DataFrame:
    """Newest price and newest sentiment per symbol, whichever of them exists.

    Prices are named by pair (BTCUSDT) and news by coin (BTC); ``normalize`` strips the quote
    currency of the prices so that they meet. Both sides hold one row per symbol.
    """
    prices, moods = latest_prices, market_sentiment
    if normalize:
        prices = prices.withColumn("symbol", normalize_symbol(F.col("symbol")))
    prices = distinct_on(prices, ["symbol"], [F.col("last_updated").desc_nulls_last()])
    moods = distinct_on(moods, ["symbol"], [F.col("sentiment_date").desc_nulls_last()])
    joined = (
        prices.alias("p")
        .join(moods.alias("s"), F.col("p.symbol") == F.col("s.symbol"), "full_outer")
        .select(
            F.coalesce("p.symbol", "s.symbol").alias("symbol"),
            "p.latest_price",
            "p.latest_volume_24h",
            "p.last_updated",
            "s.avg_sentiment_score",
            "s.market_mood",
            F.col("s.sentiment_date").alias("last_sentiment_update"),
        )
    )
    # The outer join neither drops nor repeats a price row, so counting prices is enough.
    return with_global_count(joined, F.col("latest_price") > min_price, "active_coins", of=prices)


def coin_names(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Add the display name; an unregistered symbol is shown without its quote currency."""
    names = registry.select("symbol", F.col("name").alias("_name"))
    return (
        df.join(names, "symbol", "left")
        .withColumn("name", F.coalesce("_name", short_name(F.col("symbol"))))
        .drop("_name")
    )


def market_overview(
    summary: DataFrame,
    registry: DataFrame,
    reference_symbol: str = "BTCUSDT",
    cap_multiple: float = 15.0,
) -> DataFrame:
    """Totals of the newest day: volume, approximated cap, and the reference coin's share.

    The summary is read once: its days are totalled and the newest total is kept.
    """
    of_reference = F.when(F.col("symbol") == reference_symbol, F.col("total_volume"))
    newest = newest_total(
        summary, F.sum("total_volume").alias("volume"), F.sum(of_reference).alias("reference")
    )
    # One row also of an empty summary.
    totals = newest.agg(
        F.coalesce(F.max("volume"), F.lit(0.0)).alias("volume"),
        F.coalesce(F.max("reference"), F.lit(0.0)).alias("reference"),
        F.max("date").alias("day"),
    )
    coins = registry.agg(F.count("*").alias("n")).scalar()
    share = F.when(F.col("day").isNull(), F.lit(0.0)).otherwise(
        numeric.share_pct(F.col("reference"), F.col("volume"), 50.0)
    )
    return totals.select(
        F.round(F.col("volume") * cap_multiple, 2).alias("total_market_cap"),
        F.round("volume", 2).alias("total_volume_24h"),
        F.round(share, 2).alias("btc_dominance"),
        coins.alias("active_coins"),
        temporal.format_utc(F.col("day")).alias("last_updated"),
    )


def newest_total(summary: DataFrame, *aggs: Column) -> DataFrame:
    """Aggregates of the newest day, in one pass over the rows; no row without a dated one."""
    dated = summary.filter(F.col("date").isNotNull())
    return dated.groupBy("date").agg(*aggs).orderBy(F.desc("date")).limit(1)


def _movers(
    summary: DataFrame, n: int, registry: DataFrame | None, first: Column, then: Column
) -> DataFrame:
    """The first ``n`` changes of the newest day.

    One pass: of the rows ranked by day and change at most ``n`` are kept, and those of older
    days, with which a short day is filled up, are dropped again.
    """
    change = numeric.pct_change(F.col("open_price"), F.col("close_price"))
    ranked = (
        summary.filter(F.col("date").isNotNull())
        .select("date", "symbol", F.round(change, 2).alias("change_pct"))
        .orderBy(F.desc("date"), first, then)
        .limit(n)
    )
    newest = F.max("date").over(Window.partitionBy(F.lit(0)))
    rows = (
        ranked.withColumn("_newest", newest)
        .filter(F.col("date") == F.col("_newest"))
        .select("symbol", "change_pct")
    )
    return rows if registry is None else coin_names(rows, registry)


def top_gainers(summary: DataFrame, n: int = 5, registry: DataFrame | None = None) -> DataFrame:
    """The ``n`` greatest changes of the newest day, greatest first."""
    rows = _movers(summary, n, registry, F.desc("change_pct"), F.col("symbol"))
    return rows.orderBy(F.desc("change_pct"), "symbol")


def top_losers(summary: DataFrame, n: int = 5, registry: DataFrame | None = None) -> DataFrame:
    """The last ``n`` of the same ranking, still in descending order."""
    rows = _movers(summary, n, registry, F.col("change_pct"), F.desc("symbol"))
    return rows.orderBy(F.desc("change_pct"), "symbol")


def coin_summary(
    summary: DataFrame, symbol: str | None = None, registry: DataFrame | None = None
) -> DataFrame:
    """The newest bar of one symbol, or of every symbol, with its change and mean price."""
    bars = summary if registry is None else symbol_filter(summary, registry, symbol)
    if symbol is not None:
        newest = (
            bars.filter(F.col("symbol") == symbol.upper()).orderBy(F.desc("date")).limit(1)
        )
    else:
        newest = latest_per_key(bars, ["symbol"], "date")
    o, c = F.col("open_price"), F.col("close_price")
    return newest.select(
        "symbol",
        temporal.format_date(F.col("date")).alias("trading_date"),
        F.round(o, 4).alias("day_open"),
        F.round(c, 4).alias("day_close"),
        F.round("high_price", 4).alias("day_high"),
        F.round("low_price", 4).alias("day_low"),
        F.round("total_volume", 2).alias("total_volume"),
        F.round((o + c) / 2, 4).alias("avg_price"),
        F.round(numeric.pct_change(o, c), 4).alias("price_change_pct"),
        F.lit(0).alias("tick_count"),
    )


def coin_history(
    summary: DataFrame,
    symbol: str | None = None,
    days: int = 30,
    registry: DataFrame | None = None,
) -> DataFrame:
    """The last ``days`` bars of one symbol, or of every symbol, oldest first."""
    if not 1 <= days <= 365:
        raise ValueError("days must be between 1 and 365")
    bars = summary if registry is None else symbol_filter(summary, registry, symbol)
    if symbol is not None:
        bars = bars.filter(F.col("symbol") == symbol.upper())
    recent = first_rows(bars, ["symbol"], [F.desc("date")], days)
    return recent.select(
        "symbol",
        temporal.format_utc(F.col("date")).alias("timestamp"),
        F.col("open_price").alias("open"),
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        F.col("close_price").alias("close"),
        F.col("total_volume").alias("volume"),
    ).orderBy("symbol", "timestamp")


def ordered(df: DataFrame, specs: Sequence[str]) -> DataFrame:
    """Sort by ``"column"``, ``"column desc"`` or ``"column desc nulls last"``."""
    order = []
    for spec in specs:
        name, _, direction = spec.strip().partition(" ")
        col = F.col(name)
        order.append(
            {
                "": col.asc(),
                "asc": col.asc(),
                "desc": col.desc(),
                "asc nulls last": col.asc_nulls_last(),
                "desc nulls last": col.desc_nulls_last(),
                "desc nulls first": col.desc_nulls_first(),
            }[direction.strip().lower()]
        )
    return df.orderBy(*order)


def coin_table(
    df: DataFrame,
    name_filter: str = "",
    sort: Sequence[str] = ("symbol",),
    page: int = 0,
    size: int = 10,
) -> DataFrame:
    """One page of the coin table: name filter in any case, sort by any columns."""
    if name_filter:
        df = df.filter(F.lower("name").contains(name_filter.lower()))
    return ordered(df, sort).offset(page * size).limit(size)


def rows_after(sort: Sequence[str], last: Mapping[str, object]) -> Column:
    """Whether a row comes behind the row ``last`` (column to value) in the order of ``sort``."""
    behind, equal = F.lit(False), F.lit(True)
    for spec in sort:
        name, _, direction = spec.strip().partition(" ")
        words = direction.strip().lower()
        descending = words.startswith("desc")
        nulls_last = "nulls last" in words or (descending and "nulls first" not in words)
        col, value = F.col(name), last[name]
        if value is None:
            later = F.lit(False) if nulls_last else col.isNotNull()
        else:
            later = F.coalesce(col < F.lit(value) if descending else col > F.lit(value), F.lit(False))
            if nulls_last:
                later = later | col.isNull()
        behind = behind | (equal & later)
        equal = equal & col.eqNullSafe(F.lit(value))
    return behind


def next_page(
    df: DataFrame,
    sort: Sequence[str],
    tie: Sequence[str],
    last: Mapping[str, object] | None = None,
    size: int = 10,
) -> DataFrame:
    """The page behind the row ``last`` of the page before; the first page without it.

    ``tie`` are columns that tell all rows apart, by which equal rows of ``sort`` are ordered. Unlike a
    page by offset, which brings all rows of the pages before it to one task, every task keeps only
    ``size`` rows, however far back the page is; and rows that are added meanwhile shift nothing.
    """
    order = [*sort, *tie]
    if last is not None:
        df = df.filter(rows_after(order, last))
    return ordered(df, order).limit(size)


def dashboard_totals(
    summary: DataFrame, market_sentiment: DataFrame, as_of: Column, days: int = 7
) -> DataFrame:
    """Coins and volume of the newest day next to the mean mood of the last days, in one row."""
    since = as_of - F.expr(f"INTERVAL '{int(days)}' DAY")
    overall = (
        market_sentiment.filter(F.col("sentiment_date") >= since)
        .agg(F.avg("avg_sentiment_score").alias("overall"))
        .scalar()
    )
    return distinct_coins(summary).withColumn("overall_sentiment", overall)


def distinct_coins(summary: DataFrame) -> DataFrame:
    """Number of symbols and total volume of the newest day."""
    symbols = F.count_distinct("symbol").alias("active_coins")
    newest = newest_total(summary, symbols, F.sum("total_volume").alias("total_volume_24h"))
    # One row also of an empty summary.
    return newest.agg(
        F.coalesce(F.max("active_coins"), F.lit(0)).cast("bigint").alias("active_coins"),
        F.max("total_volume_24h").alias("total_volume_24h"),
    )


def sentiment_vs_price(market_sentiment: DataFrame, summary: DataFrame) -> DataFrame:
    """Daily mood next to the same and the next day's price change of the symbol.

    Bars are daily, so a symbol has at most one row per day in its window.
    """
    change = numeric.pct_change(F.col("open_price"), F.col("close_price"))
    by_day = Window.partitionBy("symbol").orderBy("date")
    bars = summary.select("symbol", "date", change.alias("change_pct")).withColumn(
        "next_change_pct", F.lead("change_pct").over(by_day)
    )
    moods = market_sentiment.select(
        "symbol",
        temporal.day_of(F.col("sentiment_date")).alias("date"),
        "avg_sentiment_score",
        "total_articles",
    )
    return moods.join(bars, ["symbol", "date"])


def sentiment_price_correlation(joined: DataFrame) -> DataFrame:
    """Per symbol: does the mood go with the price of the day, and of the next day?

    Null where the mood or the change never varies, over the days that have both.
    """

    def correlation(x: str, y: str) -> Column:
        a = F.when(F.col(y).isNotNull(), F.col(x))
        b = F.when(F.col(x).isNotNull(), F.col(y))
        varies = (F.max(a) > F.min(a)) & (F.max(b) > F.min(b))
        together = F.try_divide(F.covar_pop(x, y), F.stddev_pop(a) * F.stddev_pop(b))
        return F.when(varies, together)

    return joined.groupBy("symbol").agg(
        correlation("avg_sentiment_score", "change_pct").alias("same_day_corr"),
        correlation("avg_sentiment_score", "next_change_pct").alias("next_day_corr"),
        F.count("*").alias("days"),
    )


def market_report(summary: DataFrame, registry: DataFrame, n: int = 5) -> DataFrame:
    """The overview row with its gainers and losers as nested lists of at most ``n`` coins."""
    coin = F.struct("symbol", "name", "change_pct")

    def listed(movers: DataFrame) -> Column:
        # collect_list keeps no order of its own: sort by the ranking the rows were chosen by.
        ranked = F.collect_list(
            F.struct((-F.col("change_pct")).alias("rank"), "symbol", coin.alias("coin"))
        )
        return movers.agg(
            F.transform(F.array_sort(ranked), lambda row: row["coin"]).alias("coins")
        ).scalar()

    return market_overview(summary, registry).withColumns(
        {
            "top_gainers": listed(top_gainers(summary, n, registry)),
            "top_losers": listed(top_losers(summary, n, registry)),
        }
    )


