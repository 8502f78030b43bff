"""Text sentiment: a pluggable model scorer, a lexicon scorer, and tagged news rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions.text import TITLE_RULES, symbol_from_title, words

# A scorer gets a list of texts and returns one (score, label) per text.
Scorer = Callable[[Sequence[str]], Sequence[tuple[float, str]]]

# The words of the keyword scorer.
BULLISH_WORDS = ("bull",)
BEARISH_WORDS = ("bear", "crash")


def signed_score(score: Column, label: Column) -> Column:
    """A confidence (0..1) and its class to -1..1: positive up, negative down, neutral 0."""
    kind = F.lower(label)
    return (
        F.when(kind == "positive", score).when(kind == "negative", -score).when(
            label.isNotNull(), F.lit(0.0)
        )
    )


def score_sentiment(
    df: DataFrame,
    text_col: str,
    scorer_factory: Callable[[], Scorer],
    signed: bool = True,
    max_chars: int | None = None,
) -> DataFrame:
    """Add sentiment_score, sentiment_label and scoring_error from a model.

    ``scorer_factory`` is called once per Python worker task, not per row, and the model sees
    whole batches. Blank texts are neutral without asking it. A batch the model fails on is
    retried text by text, so one bad text loses only its own score: score and label are null
    and the error is kept. Texts are scored whole; ``max_chars`` cuts them for a model that
    cannot take more. ``signed=False`` keeps the model's unsigned confidence.
    """

    def one_by_one(scorer, texts):
        for text in texts:
            try:
                score, label = scorer([text])[0]
                yield float(score), str(label), None
            except Exception as problem:
                yield None, None, f"{type(problem).__name__}: {problem}"

    @F.pandas_udf("score double, label string, error string")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = None
        for texts in batches:
            asked = [text for text in texts if text is not None and text.strip()]
            if asked and scorer is None:
                scorer = scorer_factory()
            try:
                pairs = list(scorer(asked)) if asked else []
                if len(pairs) != len(asked):
                    raise ValueError("the scorer must return one pair per text")
                answers = iter([(float(score), str(label), None) for score, label in pairs])
            except Exception:
                answers = one_by_one(scorer, asked)
            blank = (0.0, "neutral", None)
            rows = [
                next(answers) if text is not None and text.strip() else blank for text in texts
            ]
            out = pd.DataFrame(rows, columns=["score", "label", "error"])
            yield out.astype({"score": "float64", "label": object, "error": object})

    text = F.col(text_col) if max_chars is None else F.substring(F.col(text_col), 1, max_chars)
    # Called "nondeterministic" so that no later filter makes Spark run the model twice.
    rated = df.withColumn("_s", scored.asNondeterministic()(text))
    score, label = F.col("_s.score"), F.col("_s.label")
    return rated.withColumns(
        {
            "sentiment_score": signed_score(score, label) if signed else score,
            "sentiment_label": label,
            "scoring_error": F.col("_s.error"),
        }
    ).drop("_s")


def lexicon_sentiment(
    df: DataFrame,
    text_col: str,
    pos: Sequence[str] = BULLISH_WORDS,
    neg: Sequence[str] = BEARISH_WORDS,
) -> DataFrame:
    """Keyword scorer without Python: (p - n) / (p + n) over the whole text, 0 without hits."""
    tokens = words(F.coalesce(F.col(text_col), F.lit("")))

    def hits(lexicon: Sequence[str]) -> Column:
        wanted = [word.lower() for word in lexicon]
        return F.size(F.filter(F.col("_w"), lambda word: word.isin(wanted)))

    counted = df.withColumn("_w", tokens).withColumns({"_p": hits(pos), "_n": hits(neg)})
    p, n = F.col("_p"), F.col("_n")
    return counted.withColumns(
        {
            "sentiment_score": F.when(p + n > 0, (p - n).cast("double") / (p + n)).otherwise(
                F.lit(0.0)
            ),
            "sentiment_label": F.when(p > n, "positive").when(p < n, "negative").otherwise(
                "neutral"
            ),
            "scoring_error": F.lit(None).cast("string"),
        }
    ).drop("_w", "_p", "_n")


def article_key(news: DataFrame) -> Column:
    """The article's own id, or one derived from its link and title."""
    given = F.col("article_id").cast("string") if "article_id" in news.columns else F.lit(None)
    link = F.col("url") if "url" in news.columns else F.lit("")
    return F.coalesce(given, F.sha2(F.concat_ws("|", link, "title"), 256))


def enrich_news(
    news: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    rules: Sequence[tuple[str, Sequence[str]]] = TITLE_RULES,
    mode: str = "substring",
) -> DataFrame:
    """News to sentiment rows: score and tag the title, and give every article an id.

    ``scorer`` adds the three columns of ``score_sentiment`` to a frame.
    """
    return scorer(news).select(
        article_key(news).alias("article_id"),
        "title",
        symbol_from_title(F.col("title"), rules, mode).alias("symbol"),
        "published_at",
        "sentiment_score",
        "sentiment_label",
        "scoring_error",
        "source",
        F.current_timestamp().alias("ingested_at"),
    )
