"""Scoring: one model per worker task, errors kept apart, whole texts."""

import os

from pyspark.sql import functions as F

from tickhouse.operators import mood, scoring

TEXTS = ["Shares surge to record", "Losses deepen", "Board meets", "", "  ", None, "boom"]


def counting_scorer(folder):
    """A keyword model that leaves a file per construction and breaks on one word."""

    def factory():
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()

        def score(texts):
            if any("boom" in text for text in texts):
                raise RuntimeError("no answer")
            out = []
            for text in texts:
                if "surge" in text:
                    out.append((0.9, "positive"))
                elif "Losses" in text:
                    out.append((0.8, "negative"))
                else:
                    out.append((0.7, "neutral"))
            return out

        return score

    return factory


def scored(spark, tmp_path, **options):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, title string").coalesce(1)
    out = scoring.score_sentiment(df, "title", counting_scorer(str(tmp_path)), **options)
    return {r.i: (r.sentiment_score, r.sentiment_label, r.scoring_error) for r in out.collect()}


def test_scores_labels_and_errors(spark, tmp_path):
    got = scored(spark, tmp_path)
    assert got[0] == (0.9, "positive", None)
    assert got[1] == (-0.8, "negative", None)
    assert got[2] == (0.0, "neutral", None)
    assert got[3] == got[4] == got[5] == (0.0, "neutral", None)
    assert got[6] == (None, None, "RuntimeError: no answer")


def test_unsigned_scores(spark, tmp_path):
    got = scored(spark, tmp_path, signed=False)
    assert (got[1], got[2]) == ((0.8, "negative", None), (0.7, "neutral", None))


def test_model_is_built_once_per_task(spark, tmp_path):
    df = spark.range(0, 5000, 1, 2).select(F.concat(F.lit("text "), F.col("id")).alias("title"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
        out = scoring.score_sentiment(df, "title", counting_scorer(str(tmp_path)))
        assert out.filter("sentiment_label = 'neutral'").count() == 5000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert 1 <= len(os.listdir(tmp_path)) <= 2


def test_texts_are_scored_whole_unless_cut(spark):
    def factory():
        return lambda texts: [(float(len(text)), "positive") for text in texts]

    df = spark.createDataFrame([("x" * 2000,)], "title string")
    whole = scoring.score_sentiment(df, "title", factory).first()
    cut = scoring.score_sentiment(df, "title", factory, max_chars=512).first()
    assert (whole.sentiment_score, cut.sentiment_score) == (2000.0, 512.0)


def test_lexicon(spark):
    df = spark.createDataFrame(
        [("Bull run, bull!",), ("Bears? A bear. Crash, bull",), ("bullish",), (None,)], "title string"
    )
    out = scoring.lexicon_sentiment(df, "title").collect()
    assert [(round(r.sentiment_score, 4), r.sentiment_label) for r in out] == [
        (1.0, "positive"), (-0.3333, "negative"), (0.0, "neutral"), (0.0, "neutral")
    ]


def test_enriched_rows(spark, tmp_path):
    news = spark.createDataFrame(
        [("s", "Bitcoin: shares surge", "u1"), ("s", "boom", "u2"), ("s", "boom", "u3")],
        "source string, title string, url string",
    ).withColumn("published_at", F.lit("2026-05-01").cast("timestamp"))
    rate = lambda df: scoring.score_sentiment(df, "title", counting_scorer(str(tmp_path)))
    out = scoring.enrich_news(news.coalesce(1), rate)
    got = {r.symbol: r for r in out.collect()}
    assert got["BTC"].sentiment_score == 0.9 and len(got["BTC"].article_id) == 64
    assert out.select("article_id").distinct().count() == 3
    # A failed text is in no class and not counted.
    daily = mood.market_sentiment(out).collect()
    assert [(r.symbol, r.total_articles, r.market_mood) for r in daily] == [("BTC", 1, "Bullish")]
