"""Packing of token pieces into fixed-length sequences by a configuration linear program.

A configuration is a multiset of piece lengths that fits one sequence. The program asks for the
fewest configurations that hold every length as often as the histogram of lengths says. It is
solved approximately by multiplicative weights: each length has a weight, a knapsack dynamic
program finds the configuration of the greatest total weight, and the weights of the lengths in
it shrink. The solution is rounded down to whole configurations; what is left over is packed by
further knapsacks, the longest remaining piece first, as often as the remaining counts allow.

The histogram has at most ``capacity`` entries however many documents there are, so the program
runs on the driver in time that does not depend on the data. The pieces of a length are numbered
where they are cut: each task counts its own, and sums over the tasks' counts say how many come before
them, so no length, however frequent, is brought together or sorted. A piece's number finds its
place in the table of configurations, whose size is bounded by the capacity and the iterations.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.arrays import text_blocks
from tickhouse.llm.tokens import append_to_each, encoder
from tickhouse.session import settle

CAPACITY = 1024
ITERATIONS = 300
RATE = 0.3
POWER = 1.5


def piece_table(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32, part and rank.

    A document is the ids of its whole text (null: empty) and ``end_id``. Up to ``capacity`` ids
    are one piece; longer documents are cut into full pieces after a first, shorter one that
    takes what does not fill a piece. ``part`` is the task that cut a piece and ``rank`` its number among
    those of its length there; both hold for one computation of this table. ``path`` is a file of the tokenizers library. Repeated rows
    and null doc_ids are documents of their own; other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            doc_ids = batch.column(0)
            for first, last, data, starts in text_blocks(batch):
                ids, counts = append_to_each(*texts.encode(data, starts), end_id)
                edges = np.concatenate([[0], np.cumsum(counts)])
                raw = ids.astype("<u4", copy=False)
                row, piece, begin, length = cut_lengths(counts, capacity)
                crc = [
                    zlib.crc32(raw[a : a + n])
                    for a, n in zip((edges[row] + begin).tolist(), length.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(first, last - first).take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        pa.array(begin, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(np.full(len(row), part, np.int32)),
                        pa.array(rank_within(length, seen)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    )


def rank_within(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each piece's number among all of its length so far; ``seen`` counts them on."""
    order = np.argsort(length, kind="stable")
    counts = np.bincount(length, minlength=len(seen))
    first = np.cumsum(counts) - counts
    rank = np.empty(len(length), np.int64)
    rank[order] = np.arange(len(length)) - first[length[order]]
    rank += seen[length]
    seen += counts
    return rank


def cut_lengths(counts: np.ndarray, capacity: int):
    """(row, piece, start, length) of the pieces of documents of ``counts`` ids."""
    pieces = -(-counts // capacity)
    row = np.repeat(np.arange(len(counts)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    short = counts - (pieces - 1) * capacity
    begin = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
    length = np.where(piece == 0, short[row], capacity)
    return row, piece, begin, length


def knapsack(value: np.ndarray, capacity: int) -> np.ndarray:
    """Lengths of a configuration of the greatest total value; value[n] is that of length n."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        total = value[1 : room + 1] + best[room - 1 :: -1][:room]
        at = int(total.argmax())
        if total[at] > best[room - 1]:
            best[room], took[room] = total[at], at + 1
        else:
            best[room] = best[room - 1]
    return _walk(took, capacity)


def _walk(took, room):
    lengths = []
    while room > 0:
        if took[room]:
            lengths.append(int(took[room]))
            room -= int(took[room])
        else:
            room -= 1
    return np.array(lengths, np.int64)


def solve(
    histogram: np.ndarray,
    capacity: int,
    iterations: int = ITERATIONS,
    rate: float = RATE,
    power: float = POWER,
):
    """An approximate solution of the configuration program: (configurations, amounts).

    Multiplicative weights for covering. The price of a length starts at a power of its size, for
    a long piece blocks more than its share of a sequence. Lengths covered beyond the average
    lose weight exponentially, lengths that lag behind gain; covered ones are priced at nothing.
    """
    need = histogram.astype(float)
    size = np.arange(capacity + 1)
    present = need > 0
    covered = np.zeros(capacity + 1)
    amounts: dict[tuple[int, ...], float] = {}
    if not present.any():
        return [], np.empty(0)
    volume = (need * size).sum()
    step = volume / capacity / iterations
    start = (size / capacity) ** power
    weight = np.where(present, start, 0.0)
    for _ in range(3 * iterations):
        lacking = present & (covered < need - 1e-9)
        if not lacking.any():
            break
        chosen = knapsack(np.where(lacking, weight, 0.0), capacity)
        lengths, times = np.unique(chosen, return_counts=True)
        amount = min(step, ((need[lengths] - covered[lengths]) / times).min())
        covered[lengths] += amount * times
        ahead = covered[present] / need[present] - (covered * size).sum() / volume
        weight[present] = start[present] * np.exp(-rate * ahead)
        key = tuple(sorted(chosen.tolist(), reverse=True))
        amounts[key] = amounts.get(key, 0.0) + amount
    return list(amounts), np.array(list(amounts.values()))


def fill(left: np.ndarray, capacity: int) -> np.ndarray:
    """The longest remaining length and the best fit of the remaining ones beside it."""
    first = int(np.flatnonzero(left)[-1])
    chosen, room = [first], capacity - first
    left = left.copy()
    left[first] -= 1
    while room:
        fitting = np.flatnonzero(left[: room + 1])
        if not len(fitting):
            break
        sizes = np.zeros(room + 1)
        sizes[fitting] = fitting
        for n in knapsack(sizes, room).tolist():
            if left[n]:
                left[n] -= 1
                chosen.append(n)
                room -= n
            else:
                break
        else:
            break
    return np.array(chosen, np.int64)


def configurations(histogram: np.ndarray, capacity: int = CAPACITY, iterations: int = ITERATIONS):
    """Whole configurations that hold exactly ``histogram[n]`` pieces of each length n.

    Returns a list of (lengths, how often), the fractional solution rounded first.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[np.ndarray, int]] = []

    def use(lengths, wanted):
        sizes, times = np.unique(lengths, return_counts=True)
        often = int(min(wanted, (left[sizes] // times).min()))
        if often > 0:
            left[sizes] -= often * times
            plan.append((np.array(lengths, np.int64), often))
        return often

    if left[capacity]:
        use([capacity], left[capacity])
    chosen, amounts = solve(left, capacity, iterations)
    fullest = sorted(range(len(chosen)), key=lambda i: (-sum(chosen[i]), chosen[i]))
    for i in fullest:
        use(chosen[i], int(amounts[i] + 1e-9))
    while left.any():
        lengths = fill(left, capacity)
        use(lengths, left.max())
    return plan


def place_table(plan) -> dict[str, np.ndarray]:
    """For each length, which numbers of it go where: one row per configuration and slot."""
    rows = []
    used: dict[int, int] = {}
    sequence = 0
    for lengths, often in plan:
        offset = 0
        for n in lengths.tolist():
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + often
            offset += n
        sequence += often
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T))


def pack(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, iterations: int = ITERATIONS
) -> DataFrame:
    """Every piece of ``docs`` (doc_id, text) with its sequence_id and its offset in the sequence.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset; sequences are
    numbered from 0 and hold their pieces without gaps. See :func:`piece_table` for the pieces
    and for null, empty and repeated documents; an empty table gives an empty result.
    """
    pieces = settle(piece_table(docs, path, end_id, capacity), "pieces")
    # A length has one row per task.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = settle(
        counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))), "before"
    )
    # At most capacity rows, however many documents there are.
    histogram = np.zeros(capacity + 1, np.int64)
    for row in before.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    places = place_table(configurations(histogram, capacity, iterations))
    shared = docs.sparkSession.sparkContext.broadcast(places)
    # Of one length and task there are no more pieces than a task cuts, so this join has no hot key.
    numbered = pieces.join(before.select("length", "part", "before"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank")).alias("number")
    )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        span = np.int64(1) << 40
        keys = places["length"] * span + places["first"]
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length, number = column["length"].to_numpy(), column["number"].to_numpy()
            at = np.searchsorted(keys, length * span + number, "right") - 1
            sequence = places["sequence"][at] + number - places["first"][at]
            keep = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays(
                [*(column[n] for n in keep), pa.array(sequence), pa.array(places["offset"][at])],
                names=[*keep, "sequence_id", "offset"],
            )

    return numbered.mapInArrow(
        put,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
