"""Url judgement by host and path rules, then by a weighted vocabulary.

The vocabulary holds strict and soft terms with weights. An Aho-Corasick automaton finds all of
them in one pass over an url; a find counts only if no letter or digit touches it on either side.
One strict term rejects; soft terms reject when the weights of the distinct ones found reach a
limit.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A small default vocabulary.
STRICT = ("porn", "xxx", "casino", "warez", "phishing", "malware")
SOFT = {
    "adult": 1.0,
    "bet": 1.0,
    "betting": 1.0,
    "escort": 1.5,
    "free": 0.5,
    "gambling": 1.5,
    "hack": 1.0,
    "nude": 1.5,
    "poker": 1.0,
    "sex": 1.5,
    "torrent": 1.0,
    "viagra": 1.5,
}
SOFT_LIMIT = 2.0
MIN_SOFT = 2


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def matching_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule that fits, as text; null if none does. Rules are few and given by the caller."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        on, under = split_rule(rule)
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(under)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _automaton(strict, soft):
    found = ahocorasick.Automaton()
    for term, weight in soft.items():
        found.add_word(term, (term, weight))
    for term in strict:
        found.add_word(term, (term, None))
    found.make_automaton()
    return found


def _whole(text: str, first: int, last: int) -> bool:
    return not (
        (first > 0 and text[first - 1].isalnum())
        or (last + 1 < len(text) and text[last + 1].isalnum())
    )


def with_vocabulary(
    pages: DataFrame, strict=STRICT, soft: Mapping[str, float] = SOFT, column: str = "url"
) -> DataFrame:
    """``pages`` with n_strict, n_soft (distinct terms found) and soft_weight (their weights' sum).

    Urls are compared in lower case; null counts as empty. The counts are appended last, columns
    of these names that were there before are replaced.
    """
    strict, soft = tuple(strict), dict(soft)
    added = ("n_strict", "n_soft", "soft_weight")
    pages = pages.drop(*added)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _automaton(strict, soft)
        for batch in batches:
            counts = []
            for url in batch.column(batch.schema.get_field_index(column)).to_pylist():
                text = (url or "").lower()
                hits = {
                    term: weight
                    for last, (term, weight) in terms.iter(text)
                    if _whole(text, last - len(term) + 1, last)
                }
                light = [w for w in hits.values() if w is not None]
                counts.append((len(hits) - len(light), len(light), float(sum(light))))
            arrays = [
                pa.array([c[0] for c in counts], pa.int64()),
                pa.array([c[1] for c in counts], pa.int64()),
                pa.array([c[2] for c in counts], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=[*batch.schema.names, *added]
            )

    kinds = (T.LongType(), T.LongType(), T.DoubleType())
    schema = T.StructType([*pages.schema, *map(T.StructField, added, kinds)])
    return pages.mapInArrow(count, schema)


def judge_urls(
    pages: DataFrame,
    rules: Mapping[str, str],
    strict=STRICT,
    soft: Mapping[str, float] = SOFT,
    min_soft: int = MIN_SOFT,
    soft_limit: float = SOFT_LIMIT,
    column: str = "url",
) -> DataFrame:
    """``pages`` with host, path, rule, n_strict, n_soft, soft_weight and verdict.

    ``rules`` maps a host and path prefix (``example.com/en/``) to ``allow`` or ``block``; the
    longest that fits decides. Otherwise one strict term blocks, and so do ``min_soft`` distinct
    soft terms that together weigh ``soft_limit``. Null urls, urls without ``://`` and empty ones
    have empty host and path and no rule. Columns that were there under the added names are
    replaced; every row is kept, repeated ones too.
    """
    added = ("host", "path", "rule", "verdict")
    counted = with_vocabulary(pages.drop(*added), strict, soft, column)
    url = F.col(column)
    parts = counted.withColumns({"host": host_of(url), "path": path_of(url)})
    ruled = parts.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    heavy = (F.col("n_soft") >= min_soft) & (F.col("soft_weight") >= soft_limit)
    method = F.when((F.col("n_strict") > 0) | heavy, F.lit("block")).otherwise(F.lit("allow"))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    return ruled.withColumn("verdict", F.coalesce(by_rule, method))
