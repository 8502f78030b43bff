"""Tokens, keyword rules and symbol names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters, digits or underscores of any script.
WORD = r"[\p{L}\p{N}_]+"

# Ordered keyword rules of the title tagger; the first rule that matches wins.
TITLE_RULES = (
    ("BTC", ("bitcoin", "btc")),
    ("ETH", ("ethereum", "eth")),
    ("XRP", ("ripple", "xrp")),
    ("SHIB", ("shiba", "shib")),
)
OTHER = "Other"

# Stop words of the word-frequency report.
STOPWORDS = (
    "the", "a", "to", "in", "of", "and", "is", "for", "on", "with", "at", "by", "an", "be",
    "this", "that", "from", "as",
)


def words(col: Column) -> Column:
    """The lower-cased words of a text, in order."""
    return F.regexp_extract_all(F.lower(col), F.lit(WORD), F.lit(0))


def mentions(col: Column, keywords: Sequence[str], mode: str = "substring") -> Column:
    """True when a keyword occurs in the text, as a substring or as a whole word."""
    text = F.lower(col)
    if mode == "substring":
        hits = [text.contains(word.lower()) for word in keywords]
        found = hits[0]
        for hit in hits[1:]:
            found = found | hit
        return found
    if mode == "word":
        options = "|".join(re.escape(word.lower()) for word in keywords)
        return text.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{options})(?![\p{{L}}\p{{N}}_])")
    raise ValueError(f"mode must be 'substring' or 'word', not {mode!r}")


def symbol_from_title(
    col: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = TITLE_RULES,
    mode: str = "substring",
    default: str = OTHER,
) -> Column:
    """The symbol of the first rule whose keywords the text mentions."""
    symbol = F.lit(default)
    for name, keywords in reversed(rules):
        symbol = F.when(mentions(col, keywords, mode), name).otherwise(symbol)
    return symbol


def normalize_symbol(col: Column, quotes: Sequence[str] = ("USDT",)) -> Column:
    """Upper-case a pair symbol and strip its quote currency: ``btcusdt`` -> ``BTC``."""
    options = "|".join(re.escape(quote.upper()) for quote in quotes)
    return F.regexp_replace(F.upper(col), rf"(?<=.)(?:{options})$", "")


def short_name(col: Column, quote: str = "USDT") -> Column:
    return F.replace(col, F.lit(quote), F.lit(""))
