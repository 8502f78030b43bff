"""Numpy views of a batch of texts: bytes, words, hashes, ragged gathers.

Every helper works on one concatenated byte array, so a batch costs a fixed number of numpy
calls, however many texts and words it holds. Hashes are polynomial in 64 bits (wrapping), with
a random value per byte; they name words and windows and are the same on every machine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Bytes of text that one pass handles; a text above it is a pass of its own.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


@lru_cache(maxsize=8)
def _seeded(seed: int) -> tuple[np.ndarray, int, int]:
    """Value of each byte, the odd base of the polynomial and its inverse mod 2^64."""
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
    base = (0x9E3779B97F4A7C15 * (2 * seed + 1) & ((1 << 64) - 1)) | 3
    return values, base, pow(base, -1, 1 << 64)


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(seed: int, inverse: bool, n: int) -> np.ndarray:
    have = _POWERS.get((seed, inverse))
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 4096)
        base = U64(_seeded(seed)[2 if inverse else 1])
        have = np.empty(size, U64)
        have[0] = 1
        done = 1
        while done < size:
            more = min(done, size - done)
            with np.errstate(over="ignore"):  # arithmetic is modulo 2^64
                np.multiply(have[:more], have[done - 1] * base, out=have[done : done + more])
            done += more
        _POWERS[(seed, inverse)] = have
    return have[:n]


class Rolling:
    """Hashes of any substring of a byte (or 64-bit symbol) array, in constant time each."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        values = _seeded(seed)[0][data] if data.dtype == np.uint8 else mix(data + U64(seed))
        self.inverse = _powers(seed, True, len(data) + 1)
        self.prefix = np.empty(len(data) + 1, U64)
        self.prefix[0] = 0
        np.cumsum(values * _powers(seed, False, len(data)), out=self.prefix[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(U64))

    def windows(self, length: int) -> np.ndarray:
        """The hash of the window that starts at each position."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.empty(0, U64)
        return mix((self.prefix[length:] - self.prefix[:n]) * self.inverse[:n] + U64(length))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each value starts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = column.fill_null(empty)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES):
    """Runs of rows [first, last) of at most ``limit`` bytes, single longer rows by themselves."""
    first = 0
    n = len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def text_blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES):
    """(first row, last row, bytes, starts) for each block of rows of a batch."""
    data, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
    for first, last in blocks(offsets, limit):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + lengths[i] - 1 of all i, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


# The word characters of the three kinds of words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; every other byte as it is."""
    return _LOWER[data]


def word_spans(data: np.ndarray, starts: np.ndarray, alnum: bool = False):
    """Start and end of every word, and how many words each text has.

    Words are runs of bytes other than ASCII white space; with ``alnum``, runs of a-z, 0-9 and
    bytes of non-ASCII characters (lower-case first). A word never crosses the end of a text.
    """
    inside = _ALNUM[data] if alnum else ~_SPACE[data]
    n = len(data)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    cuts = starts[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    if len(cuts):
        both = cuts[inside[cuts] & inside[cuts - 1]]
        begin[both] = True
        finish[both - 1] = True
    first = np.flatnonzero(begin)
    end = np.flatnonzero(finish) + 1
    per_text = np.diff(np.searchsorted(first, starts))
    return first, end, per_text
