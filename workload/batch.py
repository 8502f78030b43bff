"""Silver, gold, joins, aggregations and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickhouse.operators import accounts, analytics, bars, dashboard, dedup, filters, incremental
from tickhouse.operators import mood, quality, scoring, series, silver
from tickhouse.session import settle
from workload.registry import query
from workload.tables import SYMBOLS, Tables

def summary(t: Tables):
    return bars.market_summary(bars.daily_ohlcv(silver.stg_historical(t.klines())),
                               t.staged_ticks(), t.as_of())


def market(t: Tables):
    return mood.market_sentiment(t.news_sentiment())


# -- filters ---------------------------------------------------------------------------


@query(
    "f1_silver_ticks",
    "select symbol, price, volume_24h, source, event_time, year(event_time)::int as year, "
    "month(event_time)::int as month, day(event_time)::int as day, "
    "hour(event_time)::int as hour from clean",
    "clean",
)
def _(t):
    return silver.silver_ticks(t.bronze(), dedup=True).select(
        "symbol", "price", "volume_24h", "source", "event_time", "year", "month", "day", "hour"
    )


@query(
    "f1_silver_ticks_seconds",
    "select symbol, price, volume_24h, date_trunc('second', event_time) as event_time "
    "from ticks where price > 0 and volume_24h > 0 qualify row_number() over (partition by "
    "symbol, date_trunc('second', event_time) order by ticks.event_time desc, event_id desc) = 1",
    "ticks",
)
def _(t):
    return silver.silver_ticks(t.bronze(), truncate_to="second", dedup=True).select(
        "symbol", "price", "volume_24h", "event_time"
    )


@query(
    "f2_silver_klines",
    "select symbol, open_time, open, high, low, close, volume, year(open_time)::int as year, "
    "month(open_time)::int as month, day(open_time)::int as day from klines where open > 0",
    "klines",
)
def _(t):
    return silver.silver_klines(t.klines()).drop("processed_at", "number_of_trades")


@query(
    "f3_silver_news",
    "select source, title, lang as description, article_id::varchar as url, "
    "case when lang = 'fr' then null else published_at end as published_at, content "
    "from news where contains(content, chr(10))",
    "news",
)
def _(t):
    # Bad input for the rules: a text of one line has no title, and French sources date oddly.
    stamp = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    odd = F.date_format("published_at", "dd/MM/yyyy 'à' HH'h'mm")
    raw = t.news().select(
        "source",
        F.when(F.col("content").contains("\n"), F.col("title")).alias("title"),
        F.col("lang").alias("description"),
        F.col("article_id").cast("string").alias("url"),
        F.when(F.col("lang") == "fr", odd).otherwise(stamp).alias("published_at"),
        "content",
        F.current_timestamp().alias("ingested_at"),
    )
    return silver.silver_news(raw).drop("ingested_at")


@query(
    "f4_silver_social",
    "select subreddit, post_id, title, text, score, num_comments, created_utc, "
    "make_timestamp(created_utc * 1000000) as created_at, url, type from social "
    "where text is not null",
    "social",
)
def _(t):
    posts = t.social().withColumn("ingested_at", F.current_timestamp())
    return silver.silver_social(posts).drop("ingested_at")


@query(
    "f5_stg_prices",
    "select symbol, price, volume, event_time, source from staged",
    "staged",
)
def _(t):
    return silver.stg_prices(t.ticks())


@query(
    "f6_stg_historical",
    "select symbol, open_time, open, high, low, close, volume from klines where open > 0",
    "klines",
)
def _(t):
    return silver.stg_historical(t.klines())


@query(
    "f7_stg_news",
    "select title, source, published_at, content from news where title is not null",
    "news",
)
def _(t):
    return silver.stg_news(t.news())


@query(
    "f7_stg_social",
    "select subreddit, post_id, title, text, score, num_comments, url, type from social "
    "where title is not null or text is not null",
    "social",
)
def _(t):
    return silver.stg_social(t.social())


@query(
    "f7_stg_news_sentiment",
    "select article_id, symbol, sentiment_score, sentiment_label, published_at "
    "from news_sentiment where sentiment_score is not null",
    "news_sentiment",
)
def _(t):
    return silver.stg_news_sentiment(t.news_sentiment())


@query(
    "f8_quarantine",
    "select event_id, symbol, price, volume_24h, case when price <= 0 then 'price_not_positive' "
    "else 'volume_not_positive' end as reject_reason from ticks "
    "where price <= 0 or volume_24h <= 0",
    "ticks",
)
def _(t):
    return silver.quarantine(t.ticks(), silver.tick_rules()).select(
        "event_id", "symbol", "price", "volume_24h", "reject_reason"
    )


@query(
    "f9_user_scope",
    "select id, user_id, symbol, condition, threshold, is_active from alerts where user_id = 7",
    "alerts",
)
def _(t):
    return filters.user_scope(t.alerts(), 7)


@query(
    "f10_symbol_filter",
    "select symbol, open_time, close from klines where symbol = 'PURCHASE' "
    "and symbol in (select symbol from coins)",
    "klines coins",
)
def _(t):
    return filters.symbol_filter(t.klines(), t.coins(), "purchase").select(
        "symbol", "open_time", "close"
    )


@query(
    "f11_recent_window",
    "select article_id, symbol, published_at, sentiment_score from news_sentiment "
    "where published_at >= (select max(published_at) from news_sentiment) - interval 7 day",
    "news_sentiment",
)
def _(t):
    rows = t.news_sentiment()
    newest = rows.agg(F.max("published_at").alias("m")).scalar()
    return filters.recent_window(rows, "published_at", newest, 7).select(
        "article_id", "symbol", "published_at", "sentiment_score"
    )


@query(
    "f12_latest_day",
    "select * from summary where date = (select max(date) from summary)",
    "summary",
)
def _(t):
    return filters.latest_day(summary(t), "date")


# -- joins -----------------------------------------------------------------------------


@query(
    "j1_dashboard_stats",
    "select coalesce(p.symbol, s.symbol) as symbol, latest_price, latest_volume_24h, "
    "last_updated, avg_sentiment_score, market_mood, sentiment_date as last_sentiment_update, "
    "count(case when latest_price > 1 then 1 end) over () as active_coins "
    "from latest_prices p full outer join (select * from mood qualify row_number() over "
    "(partition by symbol order by sentiment_date desc) = 1) s on p.symbol = s.symbol",
    "latest_prices mood",
)
def _(t):
    return dashboard.dashboard_stats(bars.latest_prices(t.staged_ticks()), market(t))


@query(
    "j1_normalized",
    "select coalesce(p.symbol, s.symbol) as symbol, latest_price, latest_volume_24h, "
    "last_updated, avg_sentiment_score, market_mood, sentiment_date as last_sentiment_update, "
    "count(case when latest_price > 1 then 1 end) over () as active_coins "
    "from latest_prices p full outer join (select * from mood qualify row_number() over "
    "(partition by symbol order by sentiment_date desc) = 1) s on p.symbol = s.symbol",
    "latest_prices mood",
)
def _(t):
    """Prices named by pair meet news named by coin."""
    prices = bars.latest_prices(t.staged_ticks())
    pairs = prices.withColumn("symbol", F.concat("symbol", F.lit("USDT")))
    return dashboard.dashboard_stats(pairs, market(t), normalize=True)


@query(
    "a5_market_report",
    "select * from (with newest as (select symbol, round(case when open_price > 0 then (close_price - open_price) / "
    "open_price * 100 else 0 end, 2) as c, total_volume from summary "
    "where date = (select max(date) from summary)) select round(sum(total_volume), 2) as "
    "total_volume_24h, (select string_agg(symbol, ',' order by c desc, symbol) from (select * from "
    "newest order by c desc, symbol limit 3)) as gainers, (select string_agg(symbol, ',' order by "
    "c desc, symbol) from (select * from newest order by c, symbol desc limit 3)) as losers from newest)",
    "summary",
)
def _(t):
    def names(movers):
        return F.array_join(F.transform(movers, lambda coin: coin["symbol"]), ",")

    return dashboard.market_report(summary(t), t.coins(), 3).select(
        "total_volume_24h", names("top_gainers").alias("gainers"), names("top_losers").alias("losers")
    )


FIRED = (
    "select id, user_id, a.symbol, condition, threshold, close_price as current_price "
    "from alerts a join (select symbol, close_price from summary "
    "qualify row_number() over (partition by symbol order by date desc) = 1) p "
    "on a.symbol = p.symbol where is_active and ((condition = 'above' and close_price >= threshold) "
    "or (condition = 'below' and close_price <= threshold))"
)


@query("j3_evaluate_alerts", FIRED, "alerts summary")
def _(t):
    return accounts.evaluate_alerts(t.alerts(), accounts.latest_closes(summary(t)))


@query(
    "j4_deactivate_alerts",
    "select id, user_id, symbol, condition, threshold, "
    f"is_active and id not in (select id from ({FIRED})) as is_active from alerts",
    "alerts summary",
)
def _(t):
    fired = accounts.evaluate_alerts(t.alerts(), accounts.latest_closes(summary(t)))
    return accounts.deactivate_alerts(t.alerts(), fired)


@query(
    "j5_coin_names",
    "select s.symbol, date, close_price, coalesce(name, replace(s.symbol, 'USDT', '')) as name "
    "from summary s left join (select * from coins where symbol <> 'VIEW') c using (symbol)",
    "summary coins",
)
def _(t):
    known = t.coins().filter("symbol <> 'VIEW'")
    return dashboard.coin_names(summary(t).select("symbol", "date", "close_price"), known)


@query(
    "j6_watchlist_add",
    "select distinct user_id, symbol from positions except select user_id, symbol from alerts",
    "positions alerts",
)
def _(t):
    return accounts.watchlist_add(t.alerts(), t.positions())


@query(
    "j7_portfolio_value",
    "select id, user_id, symbol, (quantity * b)::double as cost, "
    "(quantity * c)::double as market_value, "
    "(quantity * c - quantity * b)::double as profit from (select id, user_id, p.symbol, "
    "quantity, avg_buy_price::decimal(18,8) as b, close_price::decimal(18,8) as c "
    "from positions p left join (select symbol, close_price from summary "
    "qualify row_number() over (partition by symbol order by date desc) = 1) q "
    "on p.symbol = q.symbol)",
    "positions summary",
)
def _(t):
    valued = accounts.portfolio_value(t.positions(), accounts.latest_closes(summary(t)))
    return valued.select(
        "id", "user_id", "symbol",
        *[F.col(c).cast("double").alias(c) for c in ("cost", "market_value", "profit")],
    )


@query(
    "j7_portfolio_totals",
    "select user_id, count(*) as positions, sum(quantity * b)::double as cost, "
    "sum(quantity * c)::double as market_value, "
    "(sum(quantity * c) - sum(quantity * b))::double as profit from (select user_id, "
    "quantity, avg_buy_price::decimal(18,8) as b, close_price::decimal(18,8) as c "
    "from positions p left join (select symbol, close_price from summary "
    "qualify row_number() over (partition by symbol order by date desc) = 1) q "
    "on p.symbol = q.symbol) group by user_id",
    "positions summary",
)
def _(t):
    valued = accounts.portfolio_value(t.positions(), accounts.latest_closes(summary(t)))
    return accounts.portfolio_totals(valued).select(
        "user_id", "positions",
        *[F.col(c).cast("double").alias(c) for c in ("cost", "market_value", "profit")],
    )


VS_PRICE = (
    "select m.symbol, m.sentiment_date::date as date, round(avg_sentiment_score, 8) "
    "as avg_sentiment_score, total_articles, round(change_pct, 6) as change_pct, "
    "round(next_change_pct, 6) as next_change_pct from mood m join (select symbol, date, "
    "change_pct, lead(change_pct) over (partition by symbol order by date) as next_change_pct "
    "from (select symbol, date, case when open_price > 0 then (close_price - open_price) "
    "/ open_price * 100 else 0 end as change_pct from summary)) p "
    "on m.symbol = p.symbol and m.sentiment_date::date = p.date"
)


@query("j8_sentiment_vs_price", VS_PRICE, "mood summary")
def _(t):
    return dashboard.sentiment_vs_price(market(t), summary(t)).select(
        "symbol", "date", F.round("avg_sentiment_score", 8).alias("avg_sentiment_score"),
        "total_articles", F.round("change_pct", 6).alias("change_pct"),
        F.round("next_change_pct", 6).alias("next_change_pct"),
    )


@query(
    "j8_sentiment_price_correlation",
    "select symbol, round(corr(avg_sentiment_score, change_pct), 4) as same_day_corr, "
    "round(corr(avg_sentiment_score, next_change_pct), 4) as next_day_corr, count(*) as days "
    f"from ({VS_PRICE}) group by symbol",
    "mood summary",
)
def _(t):
    return dashboard.sentiment_price_correlation(
        dashboard.sentiment_vs_price(market(t), summary(t))
    ).select(
        "symbol", F.round("same_day_corr", 4).alias("same_day_corr"),
        F.round("next_day_corr", 4).alias("next_day_corr"), "days",
    )


@query(
    "j9_dashboard_totals",
    "select count(distinct symbol) as active_coins, sum(total_volume) as total_volume_24h, "
    "(select round(avg(avg_sentiment_score), 8) from mood where sentiment_date >= "
    "(select d from as_of) - interval 7 day) as overall_sentiment "
    "from summary where date = (select max(date) from summary)",
    "summary mood as_of",
)
def _(t):
    return dashboard.dashboard_totals(summary(t), market(t), t.as_of()).withColumn(
        "overall_sentiment", F.round("overall_sentiment", 8)
    )


# The serving side holds the candles up to the 10th; one symbol lags behind until the 5th.
HELD = (
    "select * from klines where open_time < case when symbol = 'ERROR' then "
    "timestamp '2024-01-05' else timestamp '2024-01-10' end"
)


def held(t: Tables):
    cut = F.when(F.col("symbol") == "ERROR", F.expr("timestamp_ntz'2024-01-05'")).otherwise(
        F.expr("timestamp_ntz'2024-01-10'")
    )
    return t.klines().filter(F.col("open_time") < cut)


@query(
    "j10_new_rows",
    f"select symbol, open_time, close from klines where open_time > "
    f"(select max(open_time) from ({HELD}))",
    "klines",
)
def _(t):
    return incremental.new_rows(t.klines(), held(t), "open_time").select(
        "symbol", "open_time", "close"
    )


@query(
    "j10_new_rows_per_key",
    "select k.symbol, open_time, close from klines k left join (select symbol, "
    f"max(open_time) as mark from ({HELD}) group by symbol) m on k.symbol = m.symbol "
    "where mark is null or open_time > mark",
    "klines",
)
def _(t):
    return incremental.new_rows(t.klines(), held(t), "open_time", "symbol").select(
        "symbol", "open_time", "close"
    )


# -- aggregations ----------------------------------------------------------------------


@query("a1_daily_ohlcv", "select * from daily", "daily")
def _(t):
    return bars.daily_ohlcv(silver.stg_historical(t.klines()))


@query("a2_daily_ohlcv_incremental", "select * from daily", "daily")
def _(t):
    rows = silver.stg_historical(t.klines())
    # The table ends in the middle of the 10th; that day's bar has to be replaced.
    old = bars.daily_ohlcv(rows.filter(F.col("open_time") < F.expr("timestamp_ntz'2024-01-10 12:00:00'")))
    return bars.daily_ohlcv_incremental(rows, old)


@query("a3_intraday_ohlcv", "select * from today", "today")
def _(t):
    return bars.intraday_ohlcv(t.staged_ticks(), t.as_of())


@query(
    "a4_market_sentiment",
    "select * replace (round(avg_sentiment_score, 10) as avg_sentiment_score) from mood",
    "mood",
)
def _(t):
    return market(t).withColumn("avg_sentiment_score", F.round("avg_sentiment_score", 10))


@query(
    "a5_market_overview",
    "select round(v * 15, 2) as total_market_cap, round(v, 2) as total_volume_24h, "
    "round(case when v > 0 then b / v * 100 else 50 end, 2) as btc_dominance, "
    "(select count(*) from coins) as active_coins, "
    "strftime(d, '%Y-%m-%dT%H:%M:%SZ') as last_updated from (select sum(total_volume) as v, "
    "sum(case when symbol = 'PURCHASE' then total_volume end) as b, max(date) as d "
    "from summary where date = (select max(date) from summary))",
    "summary coins",
)
def _(t):
    return dashboard.market_overview(summary(t), t.coins(), "PURCHASE")


OVERVIEW = (
    "select round(score, 4) as overall_score, case when score > 0.2 then 'Bullish' "
    "when score < -0.2 then 'Bearish' else 'Neutral' end as overall_label, "
    "round(p / n * 100, 2) as positive_pct, round(g / n * 100, 2) as negative_pct, "
    "round(u / n * 100, 2) as neutral_pct, n::bigint as article_count, "
    "strftime(d, '%Y-%m-%dT%H:%M:%SZ') as last_updated, cast(null as varchar) as status from "
)
OVERVIEW_GOLD = OVERVIEW + (
    "(select sentiment_date as d, sum(avg_sentiment_score * total_articles) "
    "/ sum(total_articles) as score, sum(total_articles) as n, sum(positive_count) as p, "
    "sum(negative_count) as g, sum(neutral_count) as u from mood "
    "where sentiment_date = (select max(sentiment_date) from mood) group by 1)"
)


@query("a6_sentiment_overview", OVERVIEW_GOLD, "mood")
def _(t):
    return mood.sentiment_overview(market(t))


@query(
    "a7_sentiment_overview_raw",
    OVERVIEW
    + "(select published_at::date as d, avg(sentiment_score) as score, count(*) as n, "
    "count(*) filter (sentiment_label = 'positive') as p, "
    "count(*) filter (sentiment_label = 'negative') as g, "
    "count(*) filter (sentiment_label = 'neutral') as u from news_sentiment "
    "where published_at::date = (select max(published_at::date) from news_sentiment) group by 1)",
    "news_sentiment",
)
def _(t):
    return mood.sentiment_overview_raw(t.news_sentiment())


@query("a8_sentiment_overview_fallback", OVERVIEW_GOLD, "mood")
def _(t):
    return mood.sentiment_overview_fallback(market(t), t.news_sentiment())


@query(
    "a9_label_distribution",
    "select sentiment_label, count(*) as count from news_sentiment group by 1",
    "news_sentiment",
)
def _(t):
    return mood.label_distribution(t.news_sentiment())


@query(
    "a10_symbol_label_counts",
    "select symbol, sentiment_label, count(*) as count from news_sentiment group by 1, 2",
    "news_sentiment",
)
def _(t):
    return mood.symbol_label_counts(t.news_sentiment())


@query(
    "a10_symbol_label_pivot",
    "select symbol, count(*) filter (sentiment_label = 'positive') as positive_count, "
    "count(*) filter (sentiment_label = 'negative') as negative_count, "
    "count(*) filter (sentiment_label = 'neutral') as neutral_count "
    "from news_sentiment group by 1",
    "news_sentiment",
)
def _(t):
    return mood.symbol_label_counts(t.news_sentiment(), pivoted=True)


@query(
    "a11_sentiment_momentum",
    "select date_trunc('hour', published_at)::timestamp as hour, "
    "round(avg(sentiment_score), 8) as avg_sentiment from news_sentiment group by 1",
    "news_sentiment",
)
def _(t):
    return mood.sentiment_momentum(t.news_sentiment()).withColumn(
        "avg_sentiment", F.round("avg_sentiment", 8)
    )


@query(
    "a12_correlation_matrix",
    "select a.symbol as symbol_a, b.symbol as symbol_b, "
    "round(corr(a.close, b.close), 6) as correlation "
    "from klines a join klines b on a.open_time = b.open_time group by 1, 2",
    "klines",
)
def _(t):
    return analytics.correlation_matrix(t.klines(), SYMBOLS).withColumn(
        "correlation", F.round("correlation", 6)
    )


@query(
    "a12_tiled_days",
    "select a.symbol as symbol_a, b.symbol as symbol_b, "
    "round(corr(a.close, b.close), 6) as correlation from (select * from klines where "
    "date_part('day', open_time) > 7) a join klines b on a.open_time = b.open_time group by 1, 2",
    "klines",
)
def _(t):
    """Moments per pair of tiles of two symbols and day; those after the seventh of a month merged."""
    moments = analytics.tile_moments(t.klines(), SYMBOLS, tile=2)
    later = moments.filter(F.dayofmonth("day") > 7)
    return analytics.correlations(later, SYMBOLS).withColumn("correlation", F.round("correlation", 6))


FLAT = (
    "select open_time, symbol, case symbol when 'CLICK' then 7.0 when 'ERROR' then 60000.1 + close / 1e6 "
    "when 'VIEW' then 60000.1 + close / 1e6 else close end as close from klines"
)


@query(
    "a12_flat_series",
    "select a.symbol as symbol_a, b.symbol as symbol_b, case when max(a.close) > min(a.close) "
    "and max(b.close) > min(b.close) then round(covar_pop(a.close - a.l, b.close - b.l) / "
    "stddev_pop(a.close - a.l) / stddev_pop(b.close - b.l), 4) end as correlation "
    "from (select k.*, case when symbol in ('ERROR', 'VIEW') then 60000.1 else 0 end as l "
    f"from ({FLAT}) k) a join (select k.*, case when symbol in ('ERROR', 'VIEW') then 60000.1 "
    f"else 0 end as l from ({FLAT}) k) b on a.open_time = b.open_time group by 1, 2",
    "klines",
)
def _(t):
    """A constant series, and small steps on a high level."""
    high = F.lit(60000.1) + F.col("close") / 1e6
    close = F.when(F.col("symbol") == "CLICK", 7.0).when(F.col("symbol").isin("ERROR", "VIEW"), high)
    rows = t.klines().withColumn("close", close.otherwise(F.col("close")))
    return analytics.correlation_matrix(rows, SYMBOLS).withColumn(
        "correlation", F.round("correlation", 4)
    )


@query(
    "w7_zero_start",
    "select symbol, open_time, case when s > 0 then round(v / s * 100, 6) end as performance from "
    "(select *, first_value(v) over (partition by symbol order by open_time) as s from (select "
    "symbol, open_time, case when symbol = 'VIEW' and open_time < timestamp '2024-01-02' then 0 "
    "else close end as v from klines))",
    "klines",
)
def _(t):
    start = (F.col("symbol") == "VIEW") & (F.col("open_time") < F.expr("timestamp_ntz'2024-01-02'"))
    rows = t.klines().select(
        "symbol", "open_time", F.when(start, F.lit(0.0)).otherwise(F.col("close")).alias("v")
    )
    return series.relative_performance(rows, "symbol", "open_time", "v").select(
        "symbol", "open_time", F.round("performance", 6).alias("performance")
    )


@query(
    "j8_constant_mood",
    "select symbol, cast(null as double) as same_day_corr, cast(null as double) as next_day_corr, "
    f"count(*) as days from ({VS_PRICE}) group by symbol",
    "mood summary",
)
def _(t):
    """All neutral: no correlation, and no failure."""
    joined = dashboard.sentiment_vs_price(market(t), summary(t))
    return dashboard.sentiment_price_correlation(joined.withColumn("avg_sentiment_score", F.lit(0.0)))


STOP = ", ".join(f"'{w}'" for w in analytics.STOPWORDS)
WORDS = (
    "select word, count(*) as count from (select unnest(regexp_extract_all(lower({col}), "
    "'[\\p{{L}}\\p{{N}}_]+')) as word from {table}) where length(word) > 3 "
    f"and word not in ({STOP}) group by word"
)


@query(
    "a13_word_frequency",
    WORDS.format(col="title", table="news") + " order by count desc, word limit 20",
    "news",
)
def _(t):
    return analytics.word_frequency(t.news(), "title")


@query(
    "a13_words_few_counters",
    WORDS.format(col="text", table="documents") + " order by count desc, word limit 10",
)
def _(t):
    """Summaries too short for the vocabulary of a task."""
    return analytics.word_frequency(t.raw("documents"), "text", 10, counters=256)


@query("a13_word_counts_full_text", WORDS.format(col="text", table="documents"))
def _(t):
    return analytics.word_counts(t.raw("documents"), "text")


@query(
    "a14_price_histogram",
    "select symbol, bin::int as bin, round(lo + bin * w, 6) as bin_start, "
    "round(lo + (bin + 1) * w, 6) as bin_end, count(*) as count from (select symbol, lo, w, "
    "case when hi > lo then least(floor((close - lo) / w), 19) else 0 end as bin "
    "from (select symbol, close, min(close) over (partition by symbol) as lo, "
    "max(close) over (partition by symbol) as hi, (max(close) over (partition by symbol) "
    "- min(close) over (partition by symbol)) / 20 as w from klines)) group by symbol, bin, lo, w",
    "klines",
)
def _(t):
    return analytics.price_histogram(t.klines()).withColumns(
        {"bin_start": F.round("bin_start", 6), "bin_end": F.round("bin_end", 6)}
    )


@query(
    "a14_quantile_classes",
    "select symbol, bin::int as bin, n as rows, true as within from (select symbol, count(price) as n "
    "from ticks group by 1) cross join range(20) r(bin)",
    "ticks",
)
def _(t):
    """Classes of equal depth by sketches; each end's exact share of the prices is within the stated error."""
    prices = t.ticks().select("symbol", "event_time", "price")
    classes = analytics.price_quantiles(analytics.price_sketches(prices, "event_time", "price"))
    ends = classes.groupBy("symbol").agg(F.collect_list(F.struct("bin", "bin_end")).alias("ends"))
    shares = (
        prices.filter("price is not null")
        .join(ends, "symbol")
        .select("symbol", "price", F.inline("ends"))
        .groupBy("symbol", "bin")
        .agg(
            F.avg((F.col("price") <= F.col("bin_end")).cast("int")).alias("upto"),
            F.avg((F.col("price") < F.col("bin_end")).cast("int")).alias("below"),
        )
    )
    share = (F.col("bin") + 1) / 20
    within = (F.col("upto") >= share - analytics.RANK_ERROR) & (F.col("below") <= share + analytics.RANK_ERROR)
    return classes.join(shares, ["symbol", "bin"]).select("symbol", "bin", "rows", within.alias("within"))


@query(
    "a15_daily_volume",
    "select symbol, open_time::date as date, sum(volume) as volume from klines group by 1, 2",
    "klines",
)
def _(t):
    return analytics.daily_volume(t.klines())


@query(
    "a16_article_counts",
    "select date_trunc('day', published_at)::timestamp as period, count(*) as articles "
    "from news group by 1",
    "news",
)
def _(t):
    return analytics.article_counts(t.news())


@query("a16_active_sources", "select source, count(*) as articles from news group by 1", "news")
def _(t):
    return analytics.active_sources(t.news())


@query(
    "a17_seasonality",
    "select symbol, (dayofweek(open_time) + 1)::int as weekday, hour(open_time)::int as hour, "
    "round(avg(close), 6) as avg_close, round(avg(volume), 6) as avg_volume, "
    "count(*) as candles from klines group by 1, 2, 3",
    "klines",
)
def _(t):
    return analytics.seasonality(t.klines()).withColumns(
        {"avg_close": F.round("avg_close", 6), "avg_volume": F.round("avg_volume", 6)}
    )


# A crude guess to grade: long titles are taken for good news.
GUESS = (
    "case when length(title) > 120 then 'positive' when length(title) > 60 then 'negative' "
    "else 'neutral' end"
)


@query(
    "a18_classification_report",
    f"select * from (with g as (select {GUESS} as p, sentiment_label as a from news_sentiment) "
    "select l as label, round(coalesce(hits / nullif(said, 0), 0), 8) as precision, "
    "round(coalesce(hits / nullif(support, 0), 0), 8) as recall, "
    "round(coalesce(2 * hits / nullif(said + support, 0), 0), 8) as f1, support "
    "from (select l, (select count(*) from g where p = l and a = l)::double as hits, "
    "(select count(*) from g where p = l) as said, (select count(*) from g where a = l) as support "
    "from (select p as l from g union select a from g)))",
    "news_sentiment",
)
def _(t):
    guessed = t.news_sentiment().withColumn("guess", F.expr(GUESS))
    report = analytics.classification_report(guessed, "guess", "sentiment_label")
    return report.withColumns(
        {name: F.round(name, 8) for name in ("precision", "recall", "f1")}
    )


@query(
    "a18_confusion_matrix",
    f"select {GUESS} as predicted, sentiment_label as actual, count(*) as count "
    "from news_sentiment group by 1, 2",
    "news_sentiment",
)
def _(t):
    guessed = t.news_sentiment().withColumn("guess", F.expr(GUESS))
    return analytics.confusion_matrix(guessed, "guess", "sentiment_label")


@query(
    "a19_hourly_sentiment_counts",
    "select date_trunc('hour', published_at)::timestamp as sentiment_hour, "
    "round(avg(sentiment_score), 8) as avg_sentiment, count(*) as article_count, "
    "count(*) filter (sentiment_label = 'positive') as positive_count, "
    "count(*) filter (sentiment_label = 'negative') as negative_count "
    "from news_sentiment group by 1",
    "news_sentiment",
)
def _(t):
    return mood.hourly_sentiment_counts(t.news_sentiment()).withColumn(
        "avg_sentiment", F.round("avg_sentiment", 8)
    )


@query(
    "a20_distinct_coins",
    "select count(distinct symbol) as active_coins, sum(total_volume) as total_volume_24h "
    "from summary where date = (select max(date) from summary)",
    "summary",
)
def _(t):
    return dashboard.distinct_coins(summary(t))


@query(
    "a21_forecast_error",
    "select symbol, round(sqrt(avg((close - open) * (close - open))), 6) as rmse "
    "from klines group by 1",
    "klines",
)
def _(t):
    return analytics.forecast_error(t.klines(), "close", "open", ["symbol"]).withColumn(
        "rmse", F.round("rmse", 6)
    )


# -- windows ---------------------------------------------------------------------------


@query(
    "w1_latest_per_key",
    "select event_id, symbol, price, event_time from ticks qualify row_number() over "
    "(partition by symbol order by event_time desc) = 1",
    "ticks",
)
def _(t):
    return dedup.latest_per_key(
        t.ticks().select("event_id", "symbol", "price", "event_time"),
        ["symbol"], "event_time", [F.desc("event_id")],
    )


@query("w1_gold_latest_prices", "select * from latest_prices", "latest_prices")
def _(t):
    return bars.latest_prices(t.staged_ticks())


@query(
    "w2_distinct_on",
    "select distinct on (symbol) symbol, sentiment_date, market_mood, total_articles from mood "
    "order by symbol, sentiment_date desc",
    "mood",
)
def _(t):
    return dedup.distinct_on(market(t), ["symbol"], [F.desc("sentiment_date")]).select(
        "symbol", "sentiment_date", "market_mood", "total_articles"
    )


@query(
    "w3_first_value",
    "select symbol, open_time, open, first_value(open) over (partition by symbol, "
    "open_time::date order by open_time) as first_open from klines",
    "klines",
)
def _(t):
    rows = t.klines().select("symbol", "open_time", F.to_date("open_time").alias("d"), "open")
    return series.first_last(rows, ["symbol", "d"], ["open_time"], ["open"]).select(
        "symbol", "open_time", "open", "first_open"
    )


@query(
    "w4_last_value",
    "select symbol, open_time, close, last_value(close) over (partition by symbol, "
    "open_time::date order by open_time rows between unbounded preceding and "
    "unbounded following) as last_close from klines",
    "klines",
)
def _(t):
    rows = t.klines().select("symbol", "open_time", F.to_date("open_time").alias("d"), "close")
    return series.first_last(rows, ["symbol", "d"], ["open_time"], ["close"]).select(
        "symbol", "open_time", "close", "last_close"
    )


@query(
    "w5_partition_stats",
    "select symbol, open_time, max(high) over p as day_high, min(low) over p as day_low, "
    "sum(volume) over p as day_volume from klines window p as (partition by symbol, "
    "open_time::date)",
    "klines",
)
def _(t):
    rows = t.klines().withColumn("d", F.to_date("open_time"))
    return series.partition_stats(
        rows, ["symbol", "d"],
        {"day_high": F.max("high"), "day_low": F.min("low"), "day_volume": F.sum("volume")},
    ).select("symbol", "open_time", "day_high", "day_low", "day_volume")


@query(
    "w6_with_global_count",
    "select symbol, latest_price, count(case when latest_price > 1 then 1 end) over () "
    "as active_coins from latest_prices",
    "latest_prices",
)
def _(t):
    prices = bars.latest_prices(t.staged_ticks()).select("symbol", "latest_price")
    return dashboard.with_global_count(prices, F.col("latest_price") > 1, "active_coins")


@query(
    "w7_relative_performance",
    "select symbol, open_time, round(close / first_value(close) over (partition by symbol "
    "order by open_time) * 100, 6) as performance from klines",
    "klines",
)
def _(t):
    rows = t.klines().select("symbol", "open_time", "close")
    return series.relative_performance(rows, "symbol", "open_time", "close").select(
        "symbol", "open_time", F.round("performance", 6).alias("performance")
    )


SCALED = (
    "select symbol, open_time, case when max(close) over s > min(close) over s then "
    "(close - min(close) over s) / (max(close) over s - min(close) over s) else 0 end as scaled "
    "from klines window s as (partition by symbol)"
)


@query(
    "w8_sequence_windows",
    "select symbol, open_time, round(list_sum(v), 6) as total, round(v[1], 8) as oldest, "
    "round(v[60], 8) as newest, round(scaled, 8) as target from (select symbol, open_time, scaled, "
    "list(scaled) over (partition by symbol order by open_time rows between 60 preceding and "
    f"1 preceding) as v from ({SCALED})) where len(v) = 60",
    "klines",
)
def _(t):
    scaled = series.min_max_scale(t.klines(), "symbol", "close")
    windows = series.sequence_windows(scaled, "symbol", "open_time", "scaled", 60)
    v = F.col("window")
    return windows.select(
        "symbol", "open_time",
        F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.round(v[0], 8).alias("oldest"), F.round(v[59], 8).alias("newest"),
        F.round("target", 8).alias("target"),
    )


@query(
    "w9_min_max_scale",
    f"select symbol, open_time, round(scaled, 8) as scaled from ({SCALED})",
    "klines",
)
def _(t):
    return series.min_max_scale(t.klines(), "symbol", "close").select(
        "symbol", "open_time", F.round("scaled", 8).alias("scaled")
    )


@query(
    "w10_rolling_features",
    "select symbol, date, round(avg(close_price) over w, 6) as close_price_rolling_mean, "
    "round(stddev_samp(close_price) over w, 6) as close_price_rolling_std from daily "
    "window w as (partition by symbol order by date rows between 6 preceding and current row)",
    "daily",
)
def _(t):
    daily = bars.daily_ohlcv(silver.stg_historical(t.klines()))
    rolled = series.rolling_features(daily, "symbol", "date", ["close_price"])
    return rolled.select(
        "symbol", "date",
        F.round("close_price_rolling_mean", 6).alias("close_price_rolling_mean"),
        F.round("close_price_rolling_std", 6).alias("close_price_rolling_std"),
    )


@query(
    "w11_pct_changes",
    "select symbol, open_time, "
    "round((close - lag(close) over w) / nullif(lag(close) over w, 0) * 100, 6) "
    "as close_change_pct, "
    "round((volume - lag(volume) over w) / nullif(lag(volume) over w, 0) * 100, 6) "
    "as volume_change_pct from klines window w as (partition by symbol order by open_time)",
    "klines",
)
def _(t):
    moved = series.pct_changes(t.klines(), "symbol", "open_time", ["close", "volume"])
    return moved.select(
        "symbol", "open_time", F.round("close_change_pct", 6).alias("close_change_pct"),
        F.round("volume_change_pct", 6).alias("volume_change_pct"),
    )


@query(
    "w11_null_keys",
    "select event_id, symbol, round((price - p) / nullif(p, 0) * 100, 6) as price_change_pct from "
    "(select *, case when symbol is not null then lag(price) over (partition by symbol order by "
    "event_time) end as p from (select event_id, case when event_id % 9 <> 0 then symbol end as "
    "symbol, event_time, price from ticks))",
    "ticks",
)
def _(t):
    """Rows without a symbol keep their place in the table, without a change."""
    rows = t.ticks().select(
        "event_id", F.when(F.col("event_id") % 9 != 0, F.col("symbol")).alias("symbol"),
        "event_time", "price",
    )
    moved = series.pct_changes(rows, "symbol", "event_time", ["price"])
    return moved.select(
        "event_id", "symbol", F.round("price_change_pct", 6).alias("price_change_pct")
    )


# -- sorts and top-k -------------------------------------------------------------------


COIN = (
    "select symbol, strftime(date, '%Y-%m-%d') as trading_date, round(open_price, 4) as day_open, "
    "round(close_price, 4) as day_close, round(high_price, 4) as day_high, "
    "round(low_price, 4) as day_low, round(total_volume, 2) as total_volume, "
    "round((open_price + close_price) / 2, 4) as avg_price, round(case when open_price > 0 then "
    "(close_price - open_price) / open_price * 100 else 0 end, 4) as price_change_pct, "
    "0 as tick_count from summary "
)


@query(
    "k1_coin_summary",
    COIN + "where symbol = 'CLICK' order by date desc limit 1",
    "summary",
)
def _(t):
    return dashboard.coin_summary(summary(t), "click", t.coins())


@query(
    "k1_coin_summaries",
    COIN + "qualify row_number() over (partition by symbol order by date desc) = 1",
    "summary",
)
def _(t):
    return dashboard.coin_summary(summary(t))


HISTORY = (
    "select symbol, strftime(date, '%Y-%m-%dT%H:%M:%SZ') as timestamp, open_price as open, "
    "high_price as high, low_price as low, close_price as close, total_volume as volume "
    "from summary {where} qualify row_number() over (partition by symbol order by date desc) <= {n}"
)


@query("k2_coin_history", HISTORY.format(where="where symbol = 'VIEW'", n=7), "summary")
def _(t):
    return dashboard.coin_history(summary(t), "view", 7, t.coins())


@query("k2_coin_histories", HISTORY.format(where="", n=30), "summary")
def _(t):
    return dashboard.coin_history(summary(t))


CHANGES = (
    "select symbol, round(case when open_price > 0 then (close_price - open_price) / open_price "
    "* 100 else 0 end, 2) as change_pct, name from summary join coins using (symbol) "
    "where date = (select max(date) from summary) "
)


@query(
    "k3_top_gainers", CHANGES + "order by change_pct desc, symbol limit 3", "summary coins"
)
def _(t):
    return dashboard.top_gainers(summary(t), 3, t.coins())


@query(
    "k3_top_losers", CHANGES + "order by change_pct, symbol desc limit 3", "summary coins"
)
def _(t):
    return dashboard.top_losers(summary(t), 3, t.coins())


@query(
    "k4_high_impact_news",
    "select title, sentiment_label, round(sentiment_score, 4) as score, published_at "
    "from news_sentiment order by abs(sentiment_score) desc, published_at, title limit 10",
    "news_sentiment",
)
def _(t):
    return mood.high_impact_news(t.news_sentiment())


@query("k5_ordered_outputs", "select * from summary order by symbol, date desc", "summary")
def _(t):
    return dashboard.ordered(summary(t), ["symbol", "date desc"])


@query(
    "k6_coin_table",
    "select s.symbol, date, close_price, name from summary s join coins using (symbol) "
    "where contains(lower(name), 'i') order by date desc, s.symbol limit 10 offset 10",
    "summary coins",
)
def _(t):
    named = dashboard.coin_names(summary(t).select("symbol", "date", "close_price"), t.coins())
    return dashboard.coin_table(named, "I", ["date desc", "symbol"], page=1)


@query(
    "k6_pages_by_key",
    "select *, (row_number() over (order by close_price desc nulls first, symbol, date) - 1) // 7 as page "
    "from (select symbol, date, case when date_part('day', date) % 4 <> 0 then "
    "round(close_price / 20) end as close_price from summary)",
    "summary",
)
def _(t):
    """All pages by seeking, with nulls and ties in the sorted column."""
    price = F.when(F.dayofmonth("date") % 4 != 0, F.round(F.col("close_price") / 20))
    rows = settle(summary(t).select("symbol", "date", price.alias("close_price")), "summary")
    pages, last = [], None
    while True:
        page = dashboard.next_page(rows, ["close_price desc nulls first"], ["symbol", "date"], last, 7)
        shown = page.collect()
        if not shown:
            break
        pages.append(page.withColumn("page", F.lit(len(pages)).cast("long")))
        last = shown[-1].asDict()
    out = pages[0]
    for page in pages[1:]:
        out = out.unionByName(page)
    return out


# -- set operations --------------------------------------------------------------------


@query("u1_market_summary", "select * from summary", "summary")
def _(t):
    return summary(t)


@query(
    "u3_dedup_keys",
    "select event_id, symbol, date_trunc('second', event_time) as event_time, price from ticks "
    "qualify row_number() over (partition by symbol, date_trunc('second', event_time) "
    "order by event_id desc) = 1",
    "ticks",
)
def _(t):
    seconds = t.ticks().select(
        "event_id", "symbol", F.date_trunc("second", "event_time").alias("event_time"), "price"
    )
    return dedup.dedup_keys(seconds, ["symbol", "event_time"], [F.desc("event_id")])


@query(
    "u4_distinct_rows",
    "select distinct symbol, volume_24h from ticks",
    "ticks",
)
def _(t):
    return dedup.distinct_rows(t.ticks().select("symbol", "volume_24h"))


FOLD = "arg_max({f}, seq) filter (op <> 'delete' and {f} is not null and seq >= coalesce(r, -1))"
FIELDS = ("symbol", "condition", "threshold", "is_active")


def change_log(t: Tables):
    """The events as edits of the alerts: who, when, and which fields the request names."""
    kind, price, volume = F.col("symbol"), F.col("price"), F.col("volume_24h")
    users = t.raw("events").select("event_id", "user_id")
    return (
        t.ticks()
        .join(users, "event_id")
        .select(
            F.col("event_id").alias("seq"),
            F.col("user_id").alias("id"),
            F.when(kind == "SIGNUP", "insert").when(kind == "ERROR", "delete").otherwise("update")
            .alias("op"),
            F.when(volume > 30, kind).alias("symbol"),
            F.when(price > 50, "above").when(price < 10, "below").alias("condition"),
            F.when(volume < 70, price).alias("threshold"),
            F.when(volume > 90, False).alias("is_active"),
        )
    )


@query(
    "u5_apply_changes",
    # A field's last value since the last insert or delete, else the row it started from.
    "select * from (with log as (select t.event_id as seq, user_id as id, case symbol "
    "when 'SIGNUP' then 'insert' when 'ERROR' then 'delete' else 'update' end as op, "
    "case when volume_24h > 30 then symbol end as symbol, "
    "case when price > 50 then 'above' when price < 10 then 'below' end as condition, "
    "case when volume_24h < 70 then price end as threshold, "
    "case when volume_24h > 90 then false end as is_active "
    "from ticks t join events e on t.event_id = e.event_id), "
    "base as (select id, user_id, symbol, condition, threshold, is_active from alerts), "
    "reset as (select id, max(seq) as r, arg_max(op, seq) as rop from log "
    "where op <> 'update' group by id), "
    "fold as (select l.id, max(rop) as rop, "
    + ", ".join(f"{FOLD.format(f=f)} as {f}" for f in FIELDS)
    + " from log l left join reset s on l.id = s.id group by l.id) "
    "select coalesce(b.id, f.id) as id, b.user_id, coalesce(f.symbol, case when rop is null then b.symbol end) "
    "as symbol, coalesce(f.condition, case when rop is null then b.condition end) as condition, "
    "coalesce(f.threshold, case when rop is null then b.threshold end) as threshold, "
    "coalesce(f.is_active, case when rop is null then b.is_active else true end) as is_active "
    "from base b full outer join fold f on b.id = f.id "
    "where coalesce(rop, 'none') <> 'delete' and (rop = 'insert' or b.id is not null))",
    "ticks alerts",
)
def _(t):
    return accounts.apply_changes(
        t.alerts(), change_log(t), ["id"], "seq", "op", FIELDS, defaults={"is_active": True}
    )


@query(
    "u5_positions",
    "select * from (with log as (select event_id as seq, event_id % 20000 as id, case symbol "
    "when 'SIGNUP' then 'insert' when 'ERROR' then 'delete' else 'update' end as op, "
    "case when volume_24h > 60 then symbol end as symbol, "
    "case when volume_24h > 20 then event_id % 9 end as quantity, "
    "case when price > 20 then price end as avg_buy_price from ticks), "
    "reset as (select id, max(seq) as r, arg_max(op, seq) as rop from log "
    "where op <> 'update' group by id), "
    "fold as (select l.id, max(rop) as rop, "
    + ", ".join(f"{FOLD.format(f=f)} as {f}" for f in ("symbol", "quantity", "avg_buy_price"))
    + " from log l left join reset s on l.id = s.id group by l.id) "
    "select coalesce(b.id, f.id) as id, b.user_id, "
    + ", ".join(
        f"coalesce(f.{f}, case when rop is null then b.{f} end) as {f}"
        for f in ("symbol", "quantity", "avg_buy_price")
    )
    + " from positions b full outer join fold f on b.id = f.id "
    "where coalesce(rop, 'none') <> 'delete' and (rop = 'insert' or b.id is not null))",
    "ticks positions",
)
def _(t):
    kind, price, volume = F.col("symbol"), F.col("price"), F.col("volume_24h")
    log = t.ticks().select(
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 20000).alias("id"),
        F.when(kind == "SIGNUP", "insert").when(kind == "ERROR", "delete").otherwise("update")
        .alias("op"),
        F.when(volume > 60, F.lower(kind)).alias("symbol"),
        F.when(volume > 20, F.col("event_id") % 9).alias("quantity"),
        F.when(price > 20, price).alias("avg_buy_price"),
    )
    return accounts.apply_changes(
        t.positions(), log, ["id"], "seq", "op", ["symbol", "quantity", "avg_buy_price"]
    )


@query(
    "u5_watchlist",
    "select * from (with listed as (select distinct user_id, symbol from alerts), "
    "last as (select user_id % 30 as user_id, upper(event_type) as symbol, "
    "arg_max(value > 50, event_id) as added from events group by 1, 2) "
    "select coalesce(b.user_id, l.user_id) as user_id, coalesce(b.symbol, l.symbol) as symbol, "
    "case when b.user_id is not null then 'stored' end as memo "
    "from listed b full outer join last l on b.user_id = l.user_id and b.symbol = l.symbol "
    "where coalesce(added, true))",
    "alerts",
)
def _(t):
    listed = t.alerts().select("user_id", "symbol").distinct().withColumn("memo", F.lit("stored"))
    log = t.raw("events").select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") % 30).alias("user_id"),
        F.lower("event_type").alias("symbol"),
        F.when(F.col("value") > 50, "insert").otherwise("delete").alias("op"),
    )
    return accounts.apply_changes(listed, log, ["user_id", "symbol"], "seq", "op", [])


# -- quality ---------------------------------------------------------------------------


@query(
    "q1_low_le_high",
    "select symbol, date from summary where low_price > high_price",
    "summary",
)
def _(t):
    return quality.low_le_high(summary(t)).select("symbol", "date")


@query(
    "q2_unique_symbol_date",
    "select symbol, date, count(*) as cnt from summary group by 1, 2 having count(*) > 1",
    "summary",
)
def _(t):
    return quality.unique_symbol_date(summary(t))


@query(
    "q3_score_range",
    "select symbol, sentiment_date from mood where avg_sentiment_score not between -1 and 1",
    "mood",
)
def _(t):
    return quality.score_range(market(t)).select("symbol", "sentiment_date")


@query(
    "q1_planted",
    "select symbol, date from daily where date_part('day', date) % 3 = 0 and high_price > low_price",
    "daily",
)
def _(t):
    """Every third day has its extremes exchanged."""
    third = F.dayofmonth("date") % 3 == 0
    swapped = bars.daily_ohlcv(t.klines()).withColumns(
        {
            "low_price": F.when(third, F.col("high_price")).otherwise(F.col("low_price")),
            "high_price": F.when(third, F.col("low_price")).otherwise(F.col("high_price")),
        }
    )
    return quality.low_le_high(swapped).select("symbol", "date")


@query(
    "q2_planted",
    "select symbol, date, 2::bigint as cnt from daily where date_part('day', date) % 4 = 0",
    "daily",
)
def _(t):
    """Every fourth day is there twice."""
    daily = bars.daily_ohlcv(t.klines())
    return quality.unique_symbol_date(daily.unionByName(daily.filter(F.dayofmonth("date") % 4 == 0)))


@query(
    "q3_planted",
    "select symbol, sentiment_date from mood where abs(avg_sentiment_score * 2) > 1",
    "mood",
)
def _(t):
    """Scores are doubled, which takes the strong ones out of their range."""
    doubled = market(t).withColumn("avg_sentiment_score", F.col("avg_sentiment_score") * 2)
    return quality.score_range(doubled).select("symbol", "sentiment_date")


@query(
    "q4_volume_positive",
    "select symbol, open_time, volume as total_volume from klines where volume <= 0",
    "klines",
)
def _(t):
    rows = t.klines().select("symbol", "open_time", F.col("volume").alias("total_volume"))
    return quality.volume_positive(rows)


@query(
    "q5_not_null",
    "select 'latest_price' as \"column\", n as nulls from (select count(*) as n from (select "
    "distinct m.symbol from mood m where m.symbol not in (select symbol from latest_prices))) "
    "where n > 0 union all select 'last_updated', n from (select count(*) as n from (select "
    "distinct m.symbol from mood m where m.symbol not in (select symbol from latest_prices))) "
    "where n > 0",
    "mood latest_prices",
)
def _(t):
    stats = dashboard.dashboard_stats(bars.latest_prices(t.staged_ticks()), market(t))
    return quality.not_null(stats, ["symbol", "latest_price", "last_updated", "active_coins"])


@query(
    "q6_unique",
    "select source, lang, count(*) as cnt from news group by 1, 2 having count(*) > 1",
    "news",
)
def _(t):
    return quality.unique(t.news(), ["source", "lang"])


@query(
    "q6_unique_orders",
    "select l_orderkey, l_linenumber, count(*) as cnt from (select l_orderkey, l_linenumber from lineitem "
    "union all select l_orderkey, l_linenumber from lineitem where l_orderkey % 97 = 5) "
    "group by 1, 2 having count(*) > 1",
)
def _(t):
    """Nearly unique keys; the lines of some orders are there twice."""
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber")
    return quality.unique(
        lines.unionByName(lines.filter(F.col("l_orderkey") % 97 == 5)), ["l_orderkey", "l_linenumber"]
    )


# -- text ------------------------------------------------------------------------------


POS, NEG = ("the", "que", "und", "nicht"), ("that", "les", "der", "con")


def _hits(lexicon):
    wanted = ", ".join(f"'{word}'" for word in lexicon)
    return (
        "len(list_filter(regexp_extract_all(lower(content), '[\\p{L}\\p{N}_]+'), "
        f"lambda x: x in ({wanted})))"
    )


def title_hits(lexicon):
    return _hits(lexicon).replace("content", "title")


@query(
    "g2_lexicon_sentiment",
    "select article_id, round(case when p + n > 0 then (p - n)::double / (p + n) else 0 end, 8) "
    "as sentiment_score, case when p > n then 'positive' when p < n then 'negative' "
    f"else 'neutral' end as sentiment_label from (select article_id, {_hits(POS)} as p, "
    f"{_hits(NEG)} as n from news)",
    "news",
)
def _(t):
    return scoring.lexicon_sentiment(t.news(), "content", POS, NEG).select(
        "article_id", F.round("sentiment_score", 8).alias("sentiment_score"), "sentiment_label"
    )


SIGNED = (
    "case when trim(title) = '' then 0.0 when length(title) % 3 = 0 then s "
    "when length(title) % 3 = 1 then -s else 0.0 end"
)


@query(
    "g1_score_sentiment",
    f"select article_id, round({SIGNED}, 8) as sentiment_score, case when trim(title) = '' then "
    "'neutral' when length(title) % 3 = 0 then 'positive' when length(title) % 3 = 1 "
    "then 'negative' else 'neutral' end as sentiment_label from (select article_id, title, "
    "(length(title) % 100) / 100::double as s from news)",
    "news",
)
def _(t):
    return scoring.score_sentiment(
        t.news().select("article_id", "title"), "title", local_scorer()
    ).select("article_id", F.round("sentiment_score", 8).alias("sentiment_score"), "sentiment_label")


@query(
    "g1_whole_texts_unsigned",
    "select article_id, case when trim(content) = '' then 0 else (length(content) % 100) / 100::double "
    "end as sentiment_score, case when trim(content) = '' then 'neutral' when length(content) % 3 = 0 "
    "then 'positive' when length(content) % 3 = 1 then 'negative' else 'neutral' end as "
    "sentiment_label from news",
    "news",
)
def _(t):
    """Whole texts, with the model's confidence as it is."""
    scored = scoring.score_sentiment(
        t.news().select("article_id", "content"), "content", local_scorer(), signed=False
    )
    return scored.select("article_id", "sentiment_score", "sentiment_label")


def local_scorer():
    """The stand-in as a closure, which workers get by value and need not import."""

    def factory():
        labels = ("positive", "negative", "neutral")
        return lambda texts: [((len(x) % 100) / 100, labels[len(x) % 3]) for x in texts]

    return factory


TAG = (
    "case when contains(lower(title), 'bitcoin') or contains(lower(title), 'btc') then 'BTC' "
    "when contains(lower(title), 'ethereum') or contains(lower(title), 'eth') then 'ETH' "
    "when contains(lower(title), 'ripple') or contains(lower(title), 'xrp') then 'XRP' "
    "when contains(lower(title), 'shiba') or contains(lower(title), 'shib') then 'SHIB' "
    "else 'Other' end"
)


@query(
    "g3_enrich_news",
    f"select article_id::varchar as article_id, title, {TAG} as symbol, published_at, "
    "case when p + n > 0 then (p - n)::double / (p + n) else 0 end as sentiment_score, "
    "case when p > n then 'positive' when p < n then 'negative' else 'neutral' end "
    "as sentiment_label, source from (select *, "
    + title_hits(POS)
    + " as p, "
    + title_hits(NEG)
    + " as n from news)",
    "news",
)
def _(t):
    rate = lambda df: scoring.lexicon_sentiment(df, "title", POS, NEG)
    return scoring.enrich_news(t.news(), rate).drop("ingested_at", "scoring_error")

