"""Token id files compressed by Re-Pair grammars, with random access to each document.

Ids are cut into shards in ascending doc_id order. Within a shard frequent pairs of adjacent ids
are replaced by new symbols, round after round, until no pair occurs ``LEAST`` times. A round counts
all pairs that can be among the most frequent exactly, takes those at least a third as frequent as the
most frequent one, and replaces them from left to right; where two of them overlap, the more frequent
one. Nothing bounds the rounds, the rules or what a symbol expands to, and a test holds the size against
that of replacing one pair at a time. No pair spans two documents. A shard file
holds the rules, the number of ids each symbol expands to, and for each document where its symbols
and its ids start, so any document (or id) is found without expanding what lies before it.

A shard file is a blob of little-endian values::

    magic   8 bytes  "REPAIR01"
    header  8 int64  base, rules, symbols, documents, first id, ids, width, flags
    rules   2 uint32 per rule      left and right symbol; rule r is symbol base + r
    sizes   1 uint32 per rule      ids that the rule expands to
    doc_ids 1 int64 per document   (and, if flags is 1, one byte each: 1 where doc_id is null)
    places  1 int64 per document   where its symbols start, then the number of all symbols
    starts  1 int64 per document   where its ids start in the shard, then the number of all ids
    symbols ``width`` bytes each (2, 3 or 4)

Blobs are rows of a table that Spark writes, so they can lie in any store Spark reaches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm.arrays import text_blocks
from tickhouse.llm.tokens import append_to_each, encoder

MAGIC = b"REPAIR01"
# Ids of a shard, and the least count of a pair that is replaced: a rule takes 12 bytes, and
# each use of it saves a symbol of 2 to 4 bytes, so a rarer pair gains nothing.
SHARD_IDS = 1 << 20
LEAST = 6
# A round takes the pairs at least this part as frequent as the most frequent one.
STEP = 3
_BUCKET_BITS = 19

FILES = "part int, shard int, first_id long, n_ids long, content binary"


@dataclass
class Grammar:
    """Rules above the alphabet ``base``, their expansion sizes, and the compressed symbols."""

    base: int
    rules: np.ndarray
    sizes: np.ndarray
    symbols: np.ndarray
    places: np.ndarray


def compress(
    ids: np.ndarray,
    starts: np.ndarray,
    rounds: int | None = None,
    per_round: int | None = None,
    least: int = LEAST,
) -> Grammar:
    """The grammar of ``ids``, of which document i is ``ids[starts[i]:starts[i + 1]]``.

    ``rounds`` and ``per_round`` stop earlier than the least count does; by default nothing else does.
    """
    base = int(ids.max()) + 1 if len(ids) else 1
    seq = ids.astype(np.uint32)
    places = starts.copy()
    rules: list[np.ndarray] = []
    n_rules = 0
    new, level = None, least
    while rounds is None or len(rules) < rounds:
        if new is None:
            at, rank, pairs, level = frequent_pairs(seq, places, per_round, least)
        else:
            at, rank, pairs = pairs_of_new(seq, places, new, per_round, least, level)
        if not len(at):
            if new is None:
                break
            new = None
            continue
        # Pairs of the new symbols are looked at by themselves until none is as frequent as this round's.
        new = base + n_rules
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        seq[at] = (base + n_rules + rank).astype(np.uint32)
        n_rules += len(pairs)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
        places = places - np.searchsorted(at, places)
    table = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    return Grammar(base, table, expansion_sizes(base, table), seq, places)


def frequent_pairs(seq: np.ndarray, places: np.ndarray, per_round: int | None, least: int):
    """Where pairs are replaced in one round, which of the pairs that is, the pairs, and the least count."""
    if len(seq) < 2:
        return *_NONE, least
    # Buckets bound the counts of their pairs from above; pairs across documents share one that is
    # never taken.
    slot = seq[:-1] * np.uint32(0x9E3779B1) + seq[1:] * np.uint32(0x85EBCA77)
    slot >>= np.uint32(32 - _BUCKET_BITS)
    slot[between_documents(seq, places)] = 1 << _BUCKET_BITS
    bound = np.bincount(slot, minlength=(1 << _BUCKET_BITS) + 1)
    bound[-1] = 0
    enough = int(bound.max())
    while enough >= least:
        enough = max(enough // STEP, least)
        found = take_pairs(seq, np.flatnonzero((bound >= enough)[slot]), per_round, least, enough)
        if len(found[0]):
            return *found, enough
        if enough == least:
            break
    return *_NONE, least


def pairs_of_new(seq, places, new: int, per_round: int | None, least: int, enough: int):
    """As :func:`frequent_pairs`, of the pairs with a symbol from ``new`` on, at a given least count.

    Every occurrence of such a pair holds the symbol, so the counts are exact.
    """
    is_new = seq >= new
    touches = is_new[:-1] | is_new[1:]
    touches[between_documents(seq, places)] = False
    return take_pairs(seq, np.flatnonzero(touches), per_round, least, enough)


def between_documents(seq: np.ndarray, places: np.ndarray) -> np.ndarray:
    edges = places[1:-1] - 1
    return edges[(edges >= 0) & (edges < len(seq) - 1)]


_NONE = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)


def take_pairs(seq: np.ndarray, at: np.ndarray, per_round: int | None, least: int, enough: int):
    """Of the pairs at ``at``, those that occur ``enough`` times, without overlaps."""
    keys = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
    pairs, rank, times = np.unique(keys, return_inverse=True, return_counts=True)
    taken = times >= enough
    if per_round is not None and taken.sum() > per_round:
        taken[np.argsort(-times, kind="stable")[per_round:]] = False
    found = taken[rank]
    at, rank = at[found], rank[found]
    keep = without_overlaps(at, times[rank])
    at, rank = at[keep], rank[keep]
    used = np.bincount(rank, minlength=len(pairs)) >= least
    found = used[rank]
    if not found.any():
        return _NONE
    number = np.cumsum(used) - 1
    return at[found], number[rank[found]], pairs[used]


def without_overlaps(at: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Which of the ascending places of pairs to keep, so that no two are neighbours.

    Of neighbours of one frequency, every other one from the left; else the more frequent one.
    """
    index = np.arange(len(at))
    apart = np.r_[True, np.diff(at) > 1][: len(at)]
    fresh = apart.copy()
    fresh[1:] |= times[1:] != times[:-1]
    keep = (index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0
    touch = keep[1:] & keep[:-1] & ~apart[1:]
    first_wins = times[:-1] > times[1:]
    keep[1:][touch & first_wins] = False
    keep[:-1][touch & ~first_wins] = False
    return keep


def expansion_sizes(base: int, rules: np.ndarray) -> np.ndarray:
    sizes = [0] * len(rules)
    for r, (left, right) in enumerate(rules.tolist()):
        sizes[r] = (sizes[left - base] if left >= base else 1) + (
            sizes[right - base] if right >= base else 1
        )
    return np.array(sizes, np.uint32)


def expand(symbols: np.ndarray, base: int, rules: np.ndarray) -> np.ndarray:
    """The ids of ``symbols``: all rules are written out by one step until none is left."""
    out = symbols
    while True:
        ruled = out >= base
        if not ruled.any():
            return out
        ends = np.cumsum(ruled + 1)
        sides = rules[out[ruled] - base]
        longer = np.empty(int(ends[-1]), np.uint32)
        longer[ends - 1] = out
        longer[ends[ruled] - 2] = sides[:, 0]
        longer[ends[ruled] - 1] = sides[:, 1]
        out = longer


def to_blob(grammar: Grammar, doc_ids: list, starts: np.ndarray, first_id: int) -> bytes:
    missing = [d is None for d in doc_ids]
    top = grammar.base + len(grammar.rules)
    width = 2 if top <= 1 << 16 else 3 if top <= 1 << 24 else 4
    symbols = np.ascontiguousarray(grammar.symbols.astype("<u4")).view(np.uint8).reshape(-1, 4)
    header = np.array(
        [
            grammar.base, len(grammar.rules), len(grammar.symbols), len(doc_ids),
            first_id, starts[-1], width, int(any(missing)),
        ],
        "<i8",
    )
    parts = [
        MAGIC,
        header.tobytes(),
        grammar.rules.astype("<u4").tobytes(),
        grammar.sizes.astype("<u4").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array(missing, np.uint8).tobytes() if any(missing) else b"",
        grammar.places.astype("<i8").tobytes(),
        starts.astype("<i8").tobytes(),
        symbols[:, :width].tobytes(),
    ]
    return b"".join(parts)


class ShardFile:
    """Reads one blob; ``document`` and ``id_at`` expand only what is asked for."""

    def __init__(self, blob: bytes):
        if blob[:8] != MAGIC:
            raise ValueError("not a shard file")
        header = np.frombuffer(blob, "<i8", 8, 8)
        self.base, n_rules, n_symbols, docs, self.first_id, self.n_ids, width, flags = map(int, header)
        at = 72

        def take(kind, n):
            nonlocal at
            found = np.frombuffer(blob, kind, n, at)
            at += found.nbytes
            return found

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.sizes = take("<u4", n_rules)
        self.doc_ids = take("<i8", docs)
        self.missing = take("u1", docs if flags else 0).astype(bool)
        self.places = take("<i8", docs + 1)
        self.starts = take("<i8", docs + 1)
        symbols = np.zeros((n_symbols, 4), np.uint8)
        symbols[:, :width] = take("u1", width * n_symbols).reshape(-1, width)
        self.symbols = symbols.view("<u4").reshape(-1)

    def ids(self) -> np.ndarray:
        return expand(self.symbols, self.base, self.rules)

    def document(self, row: int) -> np.ndarray:
        part = self.symbols[self.places[row] : self.places[row + 1]]
        return self._write(part.tolist())

    def id_at(self, position: int) -> int:
        """The id at a place of the shard, by the expansion sizes alone."""
        row = int(np.searchsorted(self.starts, position, "right")) - 1
        symbols = self.symbols[self.places[row] : self.places[row + 1]].astype(np.int64)
        sizes = np.ones(len(symbols), np.int64)
        ruled = symbols >= self.base
        sizes[ruled] = self.sizes[symbols[ruled] - self.base]
        ends = np.cumsum(sizes)
        rest = position - int(self.starts[row])
        k = int(np.searchsorted(ends, rest, "right"))
        rest -= int(ends[k] - sizes[k])
        symbol = int(symbols[k])
        while symbol >= self.base:
            left, right = self.rules[symbol - self.base].tolist()
            size = int(self.sizes[left - self.base]) if left >= self.base else 1
            symbol, rest = (left, rest) if rest < size else (right, rest - size)
        return symbol

    def _write(self, symbols: list[int]) -> np.ndarray:
        out, stack = [], symbols[::-1]
        while stack:
            symbol = stack.pop()
            if symbol < self.base:
                out.append(symbol)
            else:
                left, right = self.rules[symbol - self.base].tolist()
                stack += (right, left)
        return np.array(out, np.uint32)


def write_files(
    docs: DataFrame, path: str, end_id: int, folder: str, shard_ids: int = SHARD_IDS
) -> None:
    """Write the ids of ``docs`` (doc_id, text), ascending by doc_id, as shard files in ``folder``.

    Each whole text (null: empty) is encoded by the tokenizers file at ``path`` and followed by
    ``end_id``. Null doc_ids come first; rows of one doc_id are ordered by their text, repeated
    rows are written as often as they are there. An empty table writes an empty folder.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(path)
        part = TaskContext.get().partitionId()
        names, ids, counts = [], [], []
        shard = before = held = 0

        def flush():
            nonlocal shard, before, held
            flat = np.concatenate(ids)
            starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            blob = to_blob(compress(flat, starts), names, starts, before)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([shard], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([len(flat)], pa.int64()),
                    pa.array([blob], pa.binary()),
                ],
                names=["part", "shard", "first_id", "n_ids", "content"],
            )
            shard, before, held = shard + 1, before + len(flat), 0
            names.clear(), ids.clear(), counts.clear()
            return out

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, last, data, starts in text_blocks(batch, limit=4 * shard_ids):
                block, n = append_to_each(*texts.encode(data, starts), end_id)
                names += doc_ids[first:last]
                ids.append(block)
                counts.append(n)
                held += len(block)
                if held >= shard_ids:
                    yield flush()
        if held:
            yield flush()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(write, FILES).write.parquet(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files in ``folder``: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it. Files know the ids before them in their own
    partition; the totals of the partitions, one row each, are added up here.
    """
    files = spark.read.schema(FILES).parquet(folder)
    totals = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, base = 0, {}
    for part in sorted(totals):
        base[part] = before
        before += totals[part]
    shared = spark.sparkContext.broadcast(base)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = ShardFile(blob.as_py())
                raw = file.ids().astype("<u4", copy=False)
                starts = file.starts
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                mask = file.missing if len(file.missing) else None
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids, pa.int64(), mask=mask),
                        pa.array(starts[:-1] + file.first_id + shared.value[part], pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.select("part", "content").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
