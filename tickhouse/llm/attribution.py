"""Token counts per section of a document, from one encoding of the whole document.

Texts are encoded whole, with the characters each token covers, and the tokens' intervals are joined
with the intervals of the document's sections. A token that crosses a boundary goes to one
section by an explicit rule, so the counts of a document's sections add up to its tokens:

``most``   the section with most of its characters, the first of equals (the default)
``first``  the first section that it touches
``last``   the last section that it touches

Tokens that touch no section are counted in a row without a section.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.arrays import _SPACE, ranges, text_blocks
from tickhouse.llm.quality import line_spans
from tickhouse.llm.tokens import encoder

RULES = ("most", "first", "last")
SECTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)


def assign(begin, end, section_start, section_end, rule: str = "most"):
    """The section of every token (-1: none) and whether it touches several.

    Sections are disjoint and ascending; tokens are intervals [begin, end).
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    low = np.searchsorted(section_end, begin, "right")
    high = np.searchsorted(section_start, np.maximum(end, begin + 1), "left") - 1
    section = np.where(low <= high, low, -1)
    across = high > low
    if rule == "last":
        section = np.where(across, high, section)
    elif rule == "most" and across.any():
        token = np.flatnonzero(across)
        width = high[token] - low[token] + 1
        row = np.repeat(token, width)
        choice = ranges(low[token], width)
        share = np.minimum(end[row], section_end[choice]) - np.maximum(begin[row], section_start[choice])
        order = np.lexsort((choice, -share, row))
        best = order[np.r_[True, np.diff(row[order]) > 0]]
        section[row[best]] = choice[best]
    return section, across


def with_line_sections(docs: DataFrame) -> DataFrame:
    """``docs`` with ``sections``: its lines with their line feeds.

    kind is ``blank`` for lines without a word, ``head`` for the first other line, else ``body``;
    start and end are characters. Null and empty texts have no sections; an old ``sections`` column is
    replaced.
    """
    source = docs.drop("sections")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                a, b, owner = line_spans(data, starts)
                end = np.minimum(b + 1, starts[owner + 1])
                some = end > a
                a, end, owner = a[some], end[some], owner[some]
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                words = np.concatenate([[0], np.cumsum(~_SPACE[data])])
                full = words[end] > words[a]
                which = np.flatnonzero(full)
                head = which[np.r_[True, np.diff(owner[which]) > 0]] if len(which) else which
                kind = np.where(full, "body", "blank").astype(object)
                kind[head] = "head"
                shift = chars[starts[owner]]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(owner, np.arange(last - first + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [
                            pa.array(kind, pa.string()),
                            pa.array(chars[a] - shift, pa.int64()),
                            pa.array(chars[end] - shift, pa.int64()),
                        ],
                        names=["kind", "start", "end"],
                    ),
                )
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists], names=[*batch.schema.names, "sections"]
                )

    return source.mapInArrow(make, T.StructType([*source.schema, T.StructField("sections", SECTIONS)]))


def attribute_tokens(docs: DataFrame, path: str, rule: str = "most") -> DataFrame:
    """Tokens of each section of ``docs`` (doc_id, text, sections).

    ``sections`` is an array of (kind, start, end) in characters of the text, taken in order of
    start; where they overlap, the earlier one keeps the characters. Returns doc_id, section (place
    in that order; null for tokens outside all sections), kind, start, end, n_tokens and n_crossing
    (tokens given to the section that touch others, too). Sections without tokens are
    returned with 0; null and empty texts have no tokens; a null ``sections`` is none. ``path`` is a
    file of the tokenizers library. Repeated rows and null doc_ids are documents of their own.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    order = F.array_sort(
        F.filter("sections", lambda s: s.isNotNull()),
        lambda a, b: F.when(a["start"] < b["start"], -1)
        .when(a["start"] > b["start"], 1)
        .when(a["end"] < b["end"], -1)
        .when(a["end"] > b["end"], 1)
        .otherwise(0),
    )
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(order, F.array().cast(SECTIONS)).alias("sections"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(path, spans=True)
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                part = batch.slice(first, last - first)
                yield count_block(part.column(0), part.column(2), data, starts, texts, rule)

    return source.mapInArrow(
        count,
        "doc_id long, section int, kind string, start long, end long, n_tokens long, n_crossing long",
    )


def count_block(doc_ids, sections, data, starts, texts, rule) -> pa.RecordBatch:
    _, counts, begin, end = texts.encode(data, starts)
    n = len(starts) - 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[starts]
    # One axis for the whole block; a free place between texts keeps them apart.
    base = chars[:-1] + np.arange(n)
    token_text = np.repeat(np.arange(n), counts)
    offsets = sections.offsets.to_numpy()
    values = sections.values.slice(offsets[0], offsets[-1] - offsets[0])
    owner = np.repeat(np.arange(n), np.diff(offsets))
    low, high = (
        np.clip(values.field(k).to_numpy(zero_copy_only=False).astype(np.int64), 0, np.diff(chars)[owner])
        + base[owner]
        for k in ("start", "end")
    )
    reach = np.maximum.accumulate(np.concatenate([[0], high[:-1]])) if len(high) else high
    trimmed = np.maximum(low, reach)
    solid = np.flatnonzero(high > trimmed)
    at, across = assign(
        begin + base[token_text], end + base[token_text], trimmed[solid], high[solid], rule
    )
    own = np.where(at >= 0, solid[at] if len(solid) else -1, -1)
    inside = own >= 0
    tokens = np.bincount(own[inside], minlength=len(owner))
    crossing = np.bincount(own[inside & across], minlength=len(owner))
    outside = np.bincount(token_text[~inside], minlength=n)
    rest = np.flatnonzero(outside)
    place = np.arange(len(owner)) - (offsets[:-1] - offsets[0])[owner]
    none = [None] * len(rest)
    return pa.RecordBatch.from_arrays(
        [
            doc_ids.take(pa.array(np.concatenate([owner, rest]))),
            pa.concat_arrays([pa.array(place, pa.int32()), pa.array(none, pa.int32())]),
            pa.concat_arrays([values.field("kind"), pa.array(none, pa.string())]),
            pa.concat_arrays([values.field("start"), pa.array(none, pa.int64())]),
            pa.concat_arrays([values.field("end"), pa.array(none, pa.int64())]),
            pa.array(np.concatenate([tokens, outside[rest]])),
            pa.array(np.concatenate([crossing, np.zeros(len(rest), np.int64)])),
        ],
        names=["doc_id", "section", "kind", "start", "end", "n_tokens", "n_crossing"],
    )
