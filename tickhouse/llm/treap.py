"""Ranked lexical search over K2-treaps: quadtrees of term-document grids with impact maxima.

Documents are indexed in shards of consecutive rows. A shard is a grid with a row per term, most
frequent terms first, a column per document, and at each point the impact of the term in the
document, an integer that does not depend on the query. The grid is a quadtree with k = 2: a cell
with points has up to four cells of half its side below it. Cells are in level order, four bits
each say which of its parts have points, and counting bits leads from a cell to its parts. Every cell
has the largest impact in it, stored as its distance from that of the cell above, so values fall from the
root to the points as in a heap.

A query follows the paths of all its terms' rows at once. What is ranked is a range of documents with
the cells in which the query's rows lie there; the sum of weight times cell maximum bounds the score
of each document of the range, and is the score when the range is one document. Ranges are opened
best bound first, a few dozen at a time, and a range is dropped when its bound is below the score
that the task's best documents so far have. Documents with that score are still looked at, for
the order of equal scores.

Shards and queries meet as rows: the index in one table, the items in another, in blocks. Tasks keep the
best documents per item over all their shards, and the results of the tasks are ranked. Terms are
named by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickhouse.llm.arrays import Rolling, lower, signed, text_blocks, word_spans
from tickhouse.llm.scratch import Scratch

# Bytes of text in a shard; a longer text is a shard of its own.
SHARD_BYTES = 2 << 20
# Terms of the items in a block.
BLOCK_TERMS = 1 << 16
# Ranges of documents that are opened together.
TOGETHER = 64
# Documents, and shards, that a task holds at a time.
DOCS_PER_BATCH = 1000
SHARDS_PER_BATCH = 4

SHARD = "doc_ids array<long>, terms array<long>, df array<int>, side int, deep int, top long, cells binary, drops binary"

# Parts of a cell before part c in its four bits, for all 16 cells.
_BEFORE = np.array([[bin(bits & ((1 << c) - 1)).count("1") for c in range(5)] for bits in range(16)])


def term_names(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of a block of texts, and how many each text has."""
    data = lower(data)
    first, end, per_text = word_spans(data, starts, alnum=True)
    return signed(Rolling(data, 9).between(first, end)), per_text


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The impact of a term that occurs ``tf`` times in a document of ``length`` terms."""
    m = 10 + (90 * length * n_docs) // n_terms
    return (1000000000 * tf) // (1000 * tf + 8 * m)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2^32 moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build_treap(row: np.ndarray, column: np.ndarray, value: np.ndarray, side: int):
    """(largest value, cells, drops) of distinct points of a grid of 2^side.

    cells: four bits per cell that is no point. drops: how far a cell's maximum is below that of the
    cell above it, three bytes each, in planes of two and one. Both in level order, the root first.
    """
    code = (_spread(row) << np.uint64(1)) | _spread(column)
    order = np.argsort(code)
    code, best = code[order], value[order]
    bits, drops = [], []
    for _ in range(side):
        above = code >> np.uint64(2)
        begin = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
        top = np.maximum.reduceat(best, begin)
        bits.append(np.add.reduceat(1 << (code & np.uint64(3)).astype(np.int64), begin))
        drops.append(np.repeat(top, np.diff(np.append(begin, len(code)))) - best)
        code, best = above[begin], top
    cells = np.concatenate(bits[::-1]).astype(np.uint8)
    if len(cells) % 2:
        cells = np.append(cells, np.uint8(0))
    fall = np.concatenate(drops[::-1]) if drops else np.empty(0, np.int64)
    packed = (cells[::2] | (cells[1::2] << 4)).tobytes()
    planes = (fall & 0xFFFF).astype("<u2").tobytes() + (fall >> 16).astype(np.uint8).tobytes()
    return int(best[0]), packed, planes


class Treap:
    """A shard of the index, ready to be searched."""

    def __init__(self, doc_ids, terms, df, side, deep, top, cells, drops):
        self.doc_ids = doc_ids
        self.terms = terms
        self.rows = np.empty(len(terms), np.int64)
        self.rows[row_order(terms, df)] = np.arange(len(terms))
        self.side, self.deep, self.top = side, deep, top
        n = len(drops) // 3
        self.drop = np.frombuffer(drops, "<u2", n).astype(np.int64)
        self.drop |= np.frombuffer(drops, np.uint8, n, 2 * n).astype(np.int64) << 16
        packed = np.frombuffer(cells, np.uint8)
        bits = np.empty(2 * len(packed) + 1, np.uint8)
        bits[:-1:2], bits[1::2] = packed & 15, packed >> 4
        # The last cell has no parts; it stands for "no points here".
        bits[-1] = 0
        self.bits = bits
        parts = _BEFORE[bits, 4]
        self.part = np.cumsum(parts) - parts
        self.nothing = len(bits) - 1

    def below(self, cell: np.ndarray, value: np.ndarray, part: np.ndarray):
        """The cells in part 0 to 3 of ``cell``, and their largest values (0 where there is no point).

        The root is cell 0 and has no drop, so a cell's drop is found at its number less one.
        """
        bits = self.bits[cell]
        there = ((bits >> part) & 1).astype(bool)
        at = self.part[cell] + _BEFORE[bits, part]
        at = np.where(there, at, 0)
        return np.where(there, at + 1, self.nothing), np.where(there, value - self.drop[at], 0)

    def enter(self, terms: np.ndarray):
        """(row, cell, value) of each term at the level where a cell is as wide as the shard.

        Terms that the shard does not have are at a cell without points.
        """
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        row = np.where(known, self.rows[at], 0)
        cell = np.where(known, 0, self.nothing)
        value = np.where(known, self.top, 0)
        for level in range(self.side - self.deep):
            part = 2 * ((row >> (self.side - 1 - level)) & 1)
            cell, value = self.below(cell, value, part)
        return row, cell, value

    def search(self, row, cell, value, weight, best: "Best") -> None:
        """Put this shard's documents into ``best``, as far as they belong there."""
        has = value > 0
        row, weight = row[has], weight[has]
        if not len(row):
            return
        cell, value = cell[None, has], value[None, has]
        bound = (value * weight).sum(axis=1)
        level = np.array([self.side - self.deep])
        column = np.zeros(1, np.int64)
        while len(bound):
            fit = bound >= max(best.least, 1)
            if not fit.all():
                bound, level, column, cell, value = (x[fit] for x in (bound, level, column, cell, value))
                if not len(bound):
                    return
            if len(bound) > TOGETHER:
                first = np.argpartition(-bound, TOGETHER)
                now, later = first[:TOGETHER], first[TOGETHER:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            point = level[now] == self.side
            if point.any():
                best.offer(bound[now[point]], self.doc_ids[column[now[point]]])
                now = now[~point]
            half = 2 * ((row[None, :] >> (self.side - 1 - level[now])[:, None]) & 1)
            lists = [[x[later]] for x in (bound, level, column, cell, value)]
            for side in (0, 1):
                to, top = self.below(cell[now], value[now], half + side)
                for one, new in zip(
                    lists, ((top * weight).sum(axis=1), level[now] + 1, 2 * column[now] + side, to, top)
                ):
                    one.append(new)
            bound, level, column, cell, value = (np.concatenate(x) for x in lists)


def row_order(terms: np.ndarray, df: np.ndarray) -> np.ndarray:
    """The terms' rows from the first on: the most frequent first, then by name."""
    return np.lexsort((terms, -df.astype(np.int64)))


class Best:
    """The ``k`` best documents so far; of equal scores those with the least doc_id."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.empty(0, np.int64)
        self.doc = np.empty(0, np.int64)
        self.least = 0

    def offer(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


# A doc_id that is null, in arrays; it is in front of all others.
_NULL = np.iinfo(np.int64).min


@dataclass
class LexicalIndex:
    """A table of shards (``SHARD``), the documents that have terms, and all their terms."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def count_terms(docs: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and the terms of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            for _, _, data, starts in text_blocks(batch):
                _, _, per_text = word_spans(lower(data), starts, alnum=True)
                n_docs += int((per_text > 0).sum())
                n_terms += int(per_text.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([n_docs]), pa.array([n_terms])], names=["n_docs", "n_terms"]
        )

    found = docs.select("text").mapInArrow(count, "n_docs long, n_terms long")
    total = found.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return total[0] or 0, total[1] or 0


def index_documents(docs: DataFrame, keep) -> LexicalIndex:
    """The index of ``docs`` (doc_id, text). Documents without terms are in no shard."""
    n_docs, n_terms = count_terms(docs)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(_NULL).to_numpy()
            for first, last, data, starts in text_blocks(batch, limit=SHARD_BYTES):
                names, per_text = term_names(data, starts)
                if not len(names):
                    continue
                terms, term = np.unique(names, return_inverse=True)
                n = last - first
                point, tf = np.unique(term * n + np.repeat(np.arange(n), per_text), return_counts=True)
                term, column = point // n, point % n
                df = np.bincount(term, minlength=len(terms))
                row = np.empty(len(terms), np.int64)
                row[row_order(terms, df)] = np.arange(len(terms))
                side = max(len(terms) - 1, n - 1, 1).bit_length()
                value = impacts(tf, per_text[column].astype(np.int64), n_docs, n_terms)
                top, cells, drops = build_treap(row[term], column, value, side)
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "doc_ids": ids[first:last],
                            "terms": terms,
                            "df": df.astype(np.int32),
                            "side": side,
                            "deep": int(n - 1).bit_length(),
                            "top": top,
                            "cells": cells,
                            "drops": drops,
                        }
                    ],
                    schema=pa.schema(
                        [
                            ("doc_ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.int64())),
                            ("df", pa.list_(pa.int32())), ("side", pa.int32()), ("deep", pa.int32()),
                            ("top", pa.int64()), ("cells", pa.binary()), ("drops", pa.binary()),
                        ]
                    ),
                )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    shards = docs.select(ids, "text").mapInArrow(build, SHARD)
    return LexicalIndex(keep(shards, "index"), n_docs, n_terms)


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number), item_id and terms (each once) of every row of ``items``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                names, per_text = term_names(data, starts)
                cuts = np.concatenate([[0], np.cumsum(per_text)])
                terms = [np.unique(names[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(first, last - first) for i in (0, 1)],
                        pa.array(terms, pa.list_(pa.int64())),
                    ],
                    names=["item", "item_id", "terms"],
                )

    kind = items.schema["item_id"].dataType.simpleString()
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return numbered.mapInArrow(read, f"item long, item_id {kind}, terms array<long>")


def item_blocks(index: LexicalIndex, items: DataFrame) -> DataFrame:
    """``items`` (item, terms) with the terms' weights, in blocks: items array<struct>.

    A term's weight comes from the documents that hold it, counted over all shards.
    """
    wanted = items.select("item", F.explode("terms").alias("term"))
    counts = index.shards.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), "df")))
    held = (
        counts.join(wanted.select("term").distinct(), "term")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
    )
    odds = F.lit(float(2 * index.n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    weighted = held.select("term", F.floor(F.lit(1000.0) * F.log(odds)).cast("long").alias("weight"))
    n_blocks = wanted.count() // BLOCK_TERMS + 1
    per_item = (
        wanted.join(weighted.where(F.col("weight") > 0), "term")
        .groupBy("item")
        .agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    )
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks)).alias("block")
    return per_item.groupBy(block).agg(F.collect_list(F.struct("item", "terms")).alias("items"))


def _flat(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def _block_items(items) -> tuple[np.ndarray, list]:
    """All terms of a block, and per item its number, places of its terms there, and weights."""
    lists = items.field("terms")
    cuts = lists.offsets.to_numpy()
    flat = lists.values
    terms, place = np.unique(flat.field("term").to_numpy(zero_copy_only=False), return_inverse=True)
    weights = flat.field("weight").to_numpy(zero_copy_only=False)
    numbers = items.field("item").to_pylist()
    return terms, [(i, place[a:b], weights[a:b]) for i, a, b in zip(numbers, cuts[:-1], cuts[1:])]


def searcher(k: int):
    """A function for mapInArrow: rows of a shard and a block to item, doc_id and score."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Best] = {}
        for batch in batches:
            numbers = [_flat(batch, c).to_pylist() for c in ("side", "deep", "top")]
            blobs = [_flat(batch, c) for c in ("cells", "drops")]
            lists = [_flat(batch, c) for c in ("doc_ids", "terms", "df")]
            for i in range(batch.num_rows):
                arrays = [x[i].values.to_numpy(zero_copy_only=False) for x in lists]
                treap = Treap(*arrays, *[x[i] for x in numbers], *[x[i].as_buffer() for x in blobs])
                terms, items = _block_items(_flat(batch, "items")[i].values)
                row, cell, value = treap.enter(terms)
                for item, place, weight in items:
                    best = found.setdefault(item, Best(k))
                    treap.search(row[place], cell[place], value[place], weight, best)
        names = [np.full(len(b.score), item) for item, b in found.items()]
        if names:
            docs = np.concatenate([b.doc for b in found.values()])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(names), pa.int64()),
                    pa.array(docs, pa.int64(), mask=docs == _NULL),
                    pa.array(np.concatenate([b.score for b in found.values()]), pa.int64()),
                ],
                names=["item", "doc_id", "score"],
            )

    return search


@contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """Batches of ``n`` rows for the jobs that run inside: texts, and even more shards, are large rows."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, n)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Returns item_id, rank (from 1), doc_id and score, all scores above 0; equal scores by ascending
    doc_id, null first. Terms are runs of a-z, 0-9 and non-ASCII characters after lowering A-Z; null
    and empty texts have none, and are not found or find nothing. Rows of equal item_ids or doc_ids are
    items and documents of their own. Extra columns are ignored; without documents or items the result
    is empty.

    Every shard meets every block of items, as a stated set of queries against all rows; Spark sends
    the blocks to the tasks while they are below its broadcast threshold, and pairs partitions beyond.
    """
    work = Scratch(docs.sparkSession)
    with rows_per_batch(docs.sparkSession, DOCS_PER_BATCH):
        index = index_documents(docs, work.keep)
        numbered = work.keep(item_terms(items), "items")
    with rows_per_batch(docs.sparkSession, SHARDS_PER_BATCH):
        blocks = work.keep(item_blocks(index, numbered), "blocks").select("items")
        pairs = index.shards.crossJoin(blocks)
        found = work.keep(pairs.mapInArrow(searcher(k), "item long, doc_id long, score long"), "found")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = ranked.join(numbered.select("item", "item_id"), "item")
    return work.finish(named.select("item_id", "rank", "doc_id", "score"))[0]
