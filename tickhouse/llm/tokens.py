"""Token ids of whole texts, with each distinct chunk of text tokenized once per task.

A text is cut in front of white space that follows other characters, and between a letter and one
of ``.,;:!?``. The tokenizers used here never join a token, nor normalize, across such a place, so
the ids of a text are the ids of its chunks one after another (tests compare this with encoding
whole texts). Chunks repeat a lot;
their ids are kept in a table addressed by the chunk's hash and copied out with numpy.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tickhouse.llm.arrays import _SPACE, Rolling, ranges

SLOTS = 1 << 20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True
# The kept chunks are dropped when they hold more ids than this.
KEPT_IDS = 1 << 23


def chunk_starts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every chunk, and the number of chunks of each text.

    A cut after a non-ASCII character is made only behind Latin letters (lead byte C3), so that
    non-ASCII white space stays with what follows it.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.zeros(len(starts) - 1, np.int64)
    space = _SPACE[data]
    cut = np.zeros(n, bool)
    cut[1:] = space[1:] & ~space[:-1]
    plain = np.zeros(n, bool)
    plain[1:] = data[:-1] < 0x80
    plain[2:] |= data[:-2] == 0xC3
    cut &= plain
    cut[1:] |= _STOP[data[1:]] & _LETTER[data[:-1]]
    begins = starts[:-1][np.diff(starts) > 0]
    cut[begins] = True
    first = np.flatnonzero(cut)
    return first, np.diff(np.searchsorted(first, starts))


@lru_cache(maxsize=2)
def encoder(path: str, spans: bool = False) -> "ChunkEncoder":
    """One encoder per Python worker, so that tasks share what was learned."""
    return ChunkEncoder(path, spans)


class ChunkEncoder:
    """Encodes blocks of texts; ``spans`` also gives each token's characters."""

    def __init__(self, path: str, spans: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spans = spans
        self.forget()

    def forget(self):
        self.known = np.zeros(0, np.uint64)  # sorted
        self.known_row = np.zeros(0, np.int64)
        self.slot_hash = np.zeros(SLOTS, np.uint64)
        self.slot_row = np.full(SLOTS, -1, np.int64)
        self.n_rows = 0
        self.n_ids = 0
        self.row_start = np.zeros(1 << 12, np.int64)
        self.row_len = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.begin = np.zeros(1 << 14, np.int32)
        self.end = np.zeros(1 << 14, np.int32)

    def _learn(self, hashes, chunks):
        if hasattr(self.tokenizer, "encode_batch_fast") and not self.spans:
            encoded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        else:
            encoded = self.tokenizer.encode_batch(chunks, add_special_tokens=False)
        lists = [e.ids for e in encoded]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(lengths.sum())
        rows = np.arange(self.n_rows, self.n_rows + len(lists))
        self.row_start = _room(self.row_start, self.n_rows + len(lists))
        self.row_len = _room(self.row_len, self.n_rows + len(lists))
        self.ids = _room(self.ids, self.n_ids + total)
        at = slice(self.n_ids, self.n_ids + total)
        self.ids[at] = np.fromiter((i for x in lists for i in x), np.uint32, total)
        if self.spans:
            self.begin = _room(self.begin, self.n_ids + total)
            self.end = _room(self.end, self.n_ids + total)
            self.begin[at] = np.fromiter((a for e in encoded for a, _ in e.offsets), np.int32, total)
            self.end[at] = np.fromiter((b for e in encoded for _, b in e.offsets), np.int32, total)
        self.row_start[rows] = self.n_ids + np.cumsum(lengths) - lengths
        self.row_len[rows] = lengths
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.known_row = np.concatenate([self.known_row, rows])[order]
        self.n_rows += len(lists)
        self.n_ids += total

    def _find(self, hashes):
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.known_row[at], -1)

    def _rows_of(self, data, first, last):
        hashes = Rolling(data, 3).between(first, last)
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        row = np.where(self.slot_hash[slot] == hashes, self.slot_row[slot], -1)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            wanted, where, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            where = missing[where]
            new = self._find(wanted) < 0
            if new.any():
                chunks = [
                    data[a:b].tobytes().decode("utf-8", "replace")
                    for a, b in zip(first[where[new]].tolist(), last[where[new]].tolist())
                ]
                self._learn(wanted[new], chunks)
            found = self._find(wanted)
            row[missing] = found[back]
            put = (wanted & np.uint64(SLOTS - 1)).astype(np.int64)
            self.slot_hash[put] = wanted
            self.slot_row[put] = found
        return row

    def encode(self, data: np.ndarray, starts: np.ndarray):
        """(ids, ids per text) of the texts ``data[starts[i]:starts[i + 1]]``.

        With ``spans``, (ids, ids per text, begin, end): character positions in the text.
        """
        if self.n_ids > KEPT_IDS:
            self.forget()
        first, per_text = chunk_starts(data, starts)
        last = np.append(first[1:], len(data))
        row = self._rows_of(data, first, last)
        lengths = self.row_len[row]
        take = ranges(self.row_start[row], lengths)
        sums = np.zeros(len(row) + 1, np.int64)
        np.cumsum(lengths, out=sums[1:])
        edges = np.zeros(len(per_text) + 1, np.int64)
        np.cumsum(per_text, out=edges[1:])
        counts = np.diff(sums[edges])
        ids = self.ids[take]
        if not self.spans:
            return ids, counts
        chars = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
        base = chars[first] - np.repeat(chars[starts[:-1]], per_text)
        shift = np.repeat(base, lengths)
        return ids, counts, self.begin[take] + shift, self.end[take] + shift


def _room(array, size):
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


def append_to_each(ids: np.ndarray, counts: np.ndarray, end_id: int):
    """The ids with ``end_id`` after each text, and the new counts."""
    ends = np.cumsum(counts)
    return np.insert(ids, ends, np.uint32(end_id)), counts + 1
