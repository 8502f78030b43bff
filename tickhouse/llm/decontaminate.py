"""Benchmark decontamination by suffix arrays over shards of the documents.

A shard is a block of whole texts. Its suffixes start at words, are compared word by word and are
sorted by prefix doubling over word ranks. Every suffix of every benchmark text is then looked up
by binary search, which gives the range of the shard's suffixes that share a whole window with it
(all verbatim places), and, from the neighbours of that place, the longest match.

Only suffixes that can hold a window are sorted: those followed by enough words that occur in the
benchmark at all. Texts longer than a block are shards of their own, so no match crosses a cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.arrays import Rolling, lower, text_blocks, word_spans

WINDOW = 13
# Benchmark texts are searched in blocks of at most this many bytes; each block is broadcast.
BENCHMARK_BYTES = 8 << 20

ADDED = ("n_words", "n_hit", "items", "longest", "longest_at")


class Queries:
    """The words of a block of benchmark texts and the suffixes to look up."""

    def __init__(self, texts: pa.Array, numbers: np.ndarray, window: int):
        parts, per_text = [], []
        for _, _, data, starts in text_blocks(pa.RecordBatch.from_arrays([texts], names=["text"])):
            data = lower(data)
            first, end, counts = word_spans(data, starts, alnum=True)
            parts.append(Rolling(data, 1).between(first, end))
            per_text.append(counts)
        hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        counts = np.concatenate(per_text) if per_text else np.empty(0, np.int64)
        self.vocabulary = np.unique(hashes)
        words = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 1
        item = np.repeat(np.arange(len(counts)), counts)
        ends = np.repeat(np.cumsum(counts), counts)
        at = np.arange(len(words))
        size = np.minimum(window, np.repeat(counts, counts))
        whole = at + size <= ends
        self.start, self.size = at[whole], size[whole]
        self.item = numbers[item[whole]]
        self.end = ends[whole]
        self.least = int(self.size.min()) if whole.any() else 0
        self.window = window
        self.words = np.concatenate([words, np.zeros(window + 1, np.int64)])

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words from 1 on, 0 for words that no benchmark text has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the words that follow them, to ``depth`` words at least.

    Prefix doubling over all words of the shard that can follow a place: ranks of one word, then
    of pairs of ranks at offsets 1, 2, 4, ...
    """
    rank = words
    length = 1
    while length < depth:
        after = np.zeros_like(rank)
        after[:-length] = rank[length:]
        pair = rank * (int(after.max(initial=0)) + 1) + after
        _, rank = np.unique(pair, return_inverse=True)
        length *= 2
    return places[np.argsort(rank[places], kind="stable")]


def _compare(words, at, query, start, size):
    """-1, 0 or 1 per row: the shard's suffix against the query's window of ``size`` words."""
    deep = int(size.max(initial=0))
    steps = np.arange(deep)
    mine = words[at[:, None] + steps]
    other = query[start[:, None] + steps]
    differ = (mine != other) & (steps < size[:, None])
    first = differ.argmax(axis=1)
    rows = np.arange(len(at))
    sign = np.sign(mine[rows, first] - other[rows, first])
    return np.where(differ[rows, first], sign, 0)


def search(words: np.ndarray, array: np.ndarray, queries: Queries):
    """For each query suffix the range of ``array`` whose suffixes start with its window."""
    found = []
    for upper in (False, True):
        low = np.zeros(len(queries.start), np.int64)
        high = np.full(len(queries.start), len(array))
        while (low < high).any():
            live = np.flatnonzero(low < high)
            middle = (low[live] + high[live]) >> 1
            order = _compare(
                words, array[middle], queries.words, queries.start[live], queries.size[live]
            )
            right = (order <= 0) if upper else (order < 0)
            low[live] = np.where(right, middle + 1, low[live])
            high[live] = np.where(right, high[live], middle)
        found.append(low)
    return found


def block_matches(data: np.ndarray, starts: np.ndarray, queries: Queries):
    """Matched windows in a block: (text, word in the text, words, item, longest), and words per text."""
    data = lower(data)
    first, end, per_text = word_spans(data, starts, alnum=True)
    none = [np.empty(0, np.int64)] * 5
    if not len(queries.start) or not len(first):
        return none, per_text
    known = queries.lookup(Rolling(data, 1).between(first, end))
    # A zero after every text and each unknown word ends all matches.
    owner = np.repeat(np.arange(len(per_text)), per_text)
    words = np.zeros(len(known) + len(per_text) + queries.window + 1, np.int64)
    at = np.arange(len(known)) + owner
    words[at] = known
    # Words known in a row from each place on.
    gaps = np.flatnonzero(words == 0)
    place = np.flatnonzero(words)
    run = gaps[np.searchsorted(gaps, place)] - place
    place = place[run >= queries.least]
    if not len(place):
        return none, per_text
    # Keep only the runs that hold such a place; they stay apart by the zeros between them.
    array = suffix_array_of_runs(words, place, queries)
    low, high = search(words, array, queries)
    counts = high - low
    which = np.repeat(np.arange(len(low)), counts)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    spot = array[low[which] + offset]
    longest = _extend(words, spot, queries.words, queries.start[which], queries.end[which], queries.size[which])
    back = np.full(len(words), -1)
    back[at] = np.arange(len(known))
    word = back[spot]
    text = owner[word]
    before = np.cumsum(per_text) - per_text
    return [text, word - before[text], queries.size[which], queries.item[which], longest], per_text


def suffix_array_of_runs(words: np.ndarray, place: np.ndarray, queries: Queries) -> np.ndarray:
    """The suffix array of ``place``, built over the runs of known words that hold a place."""
    run_id = np.cumsum(words == 0)
    wanted = np.zeros(run_id[-1] + 1, bool)
    wanted[run_id[place]] = True
    kept = np.flatnonzero(wanted[run_id])
    packed = np.concatenate([words[kept], np.zeros(queries.window + 1, np.int64)])
    # The zero that opens a run comes with it, so runs stay apart.
    where = np.searchsorted(kept, place)
    return kept[suffix_array(packed, where, queries.window)]


def _extend(words, spot, query, start, end, size):
    """Words in common from each found place on, within the benchmark text."""
    length = size.copy()
    live = np.arange(len(spot))
    while len(live):
        more = start[live] + length[live] < end[live]
        live = live[more]
        same = words[spot[live] + length[live]] == query[start[live] + length[live]]
        live = live[same]
        length[live] += 1
    return length


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (text and other columns) with what its texts share with ``benchmark`` (item_id, text).

    Words are runs of a-z, 0-9 and non-ASCII characters after lowering A-Z. A window is ``window``
    consecutive words of an item, or all words of an item that has fewer. Added columns: n_words,
    n_hit (words inside any found window), items (ids of the items found, sorted as strings),
    longest (words of the longest verbatim match) and longest_at (its first word). Null and empty
    texts have no words, items without words are never found, null item_ids are reported as null
    strings after the others; an empty benchmark finds nothing. Every row is kept; columns that were
    there under the added names are replaced.

    The benchmark is the query set: it is sent to the tasks in blocks of ``BENCHMARK_BYTES``.
    """
    added = ADDED
    spark = docs.sparkSession
    source = docs.drop(*added)
    blocks = []
    names: dict[int, str | None] = {}
    for texts, ids in benchmark_blocks(benchmark):
        numbers = np.arange(len(names), len(names) + len(ids))
        names.update(zip(numbers.tolist(), ids))
        blocks.append(spark.sparkContext.broadcast(Queries(texts, numbers, window)))
    labels = spark.sparkContext.broadcast([names[i] for i in range(len(names))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int64())
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                rows = summarize(data, starts, [b.value for b in blocks], labels.value)
                new = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, last - first).columns, *new],
                    names=[*batch.schema.names, *added],
                )

    longs = T.LongType()
    schema = T.StructType(
        [
            *source.schema,
            T.StructField("n_words", longs),
            T.StructField("n_hit", longs),
            T.StructField("items", T.ArrayType(T.StringType())),
            T.StructField("longest", longs),
            T.StructField("longest_at", longs),
        ]
    )
    return source.mapInArrow(scan, schema)


def benchmark_blocks(benchmark: DataFrame, limit: int = BENCHMARK_BYTES):
    """(texts, ids as strings) of the benchmark, read to the driver one block at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-int(size) // limit) if size else 0
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toArrow()
        yield part.column("text").combine_chunks().cast(pa.string()), part.column("id").to_pylist()


def summarize(data: np.ndarray, starts: np.ndarray, blocks: list[Queries], labels: list):
    """(n_words, n_hit, items, longest, longest_at) of every text of a block."""
    found, per_text = [], np.zeros(len(starts) - 1, np.int64)
    for queries in blocks:
        matches, per_text = block_matches(data, starts, queries)
        found.append(matches)
    if not blocks:
        _, _, per_text = word_spans(lower(data), starts, alnum=True)
        found.append([np.empty(0, np.int64)] * 5)
    text, word, size, item, longest = (np.concatenate(c) for c in zip(*found))
    before = np.concatenate([[0], np.cumsum(per_text)])
    change = np.zeros(int(before[-1]) + 1, np.int64)
    np.add.at(change, before[text] + word, 1)
    np.add.at(change, before[text] + word + size, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    n_hit = hit[before[1:]] - hit[before[:-1]]
    rows = [(int(n), int(h), [], 0, None) for n, h in zip(per_text, n_hit)]
    order = np.lexsort((word, -longest, text))
    for t in np.unique(text).tolist():
        mine = order[np.searchsorted(text[order], t) : np.searchsorted(text[order], t, "right")]
        ids = [labels[i] for i in np.unique(item[mine]).tolist()]
        ids = sorted(i for i in ids if i is not None) + [i for i in ids if i is None]
        best = mine[0]
        rows[t] = (*rows[t][:2], ids, int(longest[best]), int(word[best]))
    return rows


def contaminated(n_hit, n_words):
    """At least one word in twenty lies in a found window."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with their own columns only."""
    mine = [f"_{i}" for i in range(len(docs.columns))]
    text = f"_{docs.columns.index('text')}"
    found = find_matches(docs.toDF(*mine).withColumnRenamed(text, "text"), benchmark, window)
    clean = found.where(~contaminated(F.col("n_hit"), F.col("n_words")))
    return clean.withColumnRenamed("text", text).select(*mine).toDF(*docs.columns)
