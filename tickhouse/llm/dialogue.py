"""Repairs of conversations by a parallel Viterbi with rank convergence.

A repaired conversation's roles read ``(s?(ua)+)?`` by initials, and the cheapest edits into such a
form are a shortest path: four states (nothing yet, system, user, assistant), one step per row.
Costs to go form a vector of four numbers; a row turns the vector behind it into the one before it.
A conversation of any length is cut into chunks, and a chunk does not wait for the one behind it:

* The first pass starts every chunk from the vector that holds at a conversation's end, a guess for
  all chunks but the last.
* What a step does to a vector does not depend on a constant added to it. A fix-up pass reruns a
  chunk from the vector that its neighbour came to, only until that differs from the earlier run's
  by a constant; the rest of the chunk is then known. Passes go on until every chunk started
  from a vector that differs from its neighbour's result by a constant only. The vectors have few
  shapes, all that a chunk was tried with are kept, and a pass guesses past a chunk that still has to
  be rerun, so a long conversation takes a few passes and not one per chunk.
* The stitched costs decide every edit: from the front, the edit that comes first in ASCII
  among those that keep the cost. A chunk's four ways through are found at once, then the states
  at the chunk ends are joined and the edits written.

Rows are in one order over all partitions (:func:`ordered_rows`), and a chunk is a run of up to 2^12
rows there, so a conversation with a third of all rows is worked on by all tasks. What follows a
conversation from end to end handles a few numbers per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.arrays import blocks, column_bytes
from tickhouse.llm.scratch import Scratch

CHUNK_BITS = 12
# Symbols that one pass of numpy handles.
BLOCK_SYMBOLS = 1 << 19

# The costs of edits, and of leaving a truncated row.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
# States by index: nothing yet, system, user, assistant; 4 stands for no way on.
USER, ASSISTANT = 2, 3
# The state after a row that is written by rerole or insert, and after one that keeps its role,
# whose initial is s, u, a or another.
_WRITE = np.array([USER, USER, ASSISTANT, USER])
_KEEP = np.array([[1, 4, 4, 4], [USER, USER, 4, USER], [4, 4, ASSISTANT, 4], [4, 4, 4, 4]])
_NEVER = 1 << 40
# The costs at the end of a conversation, by state.
END = np.array([0, 2 * INSERT, INSERT, 0])
# Pairs of neighbours by initial: system-user, user-assistant, assistant-user.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True

# Status of a row, in this order.
FINE, CUT, BLANK, DUPLICATE = range(4)
_WORD = "[^\\x20\\x09-\\x0D]"
_WHOLE = "[.!?][\\x20\\x09-\\x0D]*\\z"
# Edits of a plan: delete, keep, rerole to user or assistant, insert user or assistant.
_PLAN = np.frombuffer(b"DKUAua", np.uint8)


def pack(vectors: np.ndarray) -> np.ndarray:
    """One number for each vector's shape, which is the vector less its least value.

    Values of one vector lie within 8 of each other: from any state a path can go on as from another
    after at most two inserts or one more delete.
    """
    shape = vectors - vectors.min(axis=1, keepdims=True)
    return (shape << (4 * np.arange(4))).sum(axis=1)


def unpack(shapes: np.ndarray) -> np.ndarray:
    return (np.asarray(shapes, np.int64)[:, None] >> (4 * np.arange(4))) & 15


END_SHAPE = int(pack(END[None])[0])


def costs_before(after: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The costs to go before rows of these codes, from those behind them."""
    kind, status = codes & 3, codes >> 2
    leave = np.where(status == CUT, TRUNCATED, 0)[:, None]
    wide = np.concatenate([after, np.full((len(after), 1), _NEVER)], axis=1)
    deleted = DELETE + after
    written = REROLE + leave + after[:, _WRITE]
    kept = leave + np.take_along_axis(wide, _KEEP[kind], axis=1)
    costs = np.where((status >= BLANK)[:, None], deleted, np.minimum(np.minimum(deleted, written), kept))
    # Rows may be inserted in front: an assistant behind a user, a user behind all others, or both.
    costs[:, :2] = np.minimum(costs[:, :2], INSERT + costs[:, [USER]])
    costs[:, :2] = np.minimum(costs[:, :2], 2 * INSERT + costs[:, [ASSISTANT]])
    costs[:, 2:] = np.minimum(costs[:, 2:], INSERT + costs[:, [ASSISTANT, USER]])
    return costs


class Chunks:
    """A block of chunks, longest first, so that those with a row at some place come first."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.codes = data.astype(np.int64) - ord("a")
        lengths = np.diff(starts)
        self.order = np.argsort(-lengths, kind="stable")
        self.first = starts[:-1][self.order]
        self.lengths = lengths[self.order]
        self.longest = int(self.lengths[0]) if len(lengths) else 0

    def active(self, place: int) -> int:
        """How many chunks have more than ``place`` rows."""
        return int(np.searchsorted(-self.lengths, -place, "left"))

    def from_end(self, place: int, n: int) -> np.ndarray:
        return self.codes[self.first[:n] + self.lengths[:n] - 1 - place]

    def restore(self, values: np.ndarray) -> np.ndarray:
        """Values in this order, in the order of the block."""
        out = np.empty_like(values)
        out[self.order] = values
        return out

    def backward(self, shapes: np.ndarray, store: np.ndarray | None = None) -> np.ndarray:
        """The costs in front of each chunk; all costs on the way go to ``store``, a row per slot.

        A chunk has a slot in front of each row and one behind the last; see :meth:`slots`.
        """
        costs = unpack(shapes)[self.order]
        if store is not None:
            slot = self.slots()
            store[slot + self.lengths] = costs
        for place in range(self.longest):
            n = self.active(place)
            costs[:n] = costs_before(costs[:n], self.from_end(place, n))
            if store is not None:
                store[slot[:n] + self.lengths[:n] - 1 - place] = costs[:n]
        return self.restore(costs)

    def slots(self) -> np.ndarray:
        return self.first + self.order

    def rerun(self, shapes: np.ndarray, tried: np.ndarray, ends: np.ndarray, shifts: np.ndarray):
        """(shape in front, shift) from other shapes than those ``tried`` before.

        Goes on only until the costs differ from those of the earlier run by a constant.
        """
        new, old = unpack(shapes)[self.order], unpack(tried)[self.order]
        front, shift = ends[self.order].copy(), shifts[self.order].copy()
        open_ = np.arange(len(new))
        for place in range(self.longest + 1):
            apart = new[open_] - old[open_]
            same = (apart == apart[:, :1]).all(axis=1)
            shift[open_[same]] += apart[same, 0]
            open_ = open_[~same]
            done = open_[self.lengths[open_] <= place]
            front[done] = pack(new[done])
            shift[done] = new[done].min(axis=1)
            open_ = open_[self.lengths[open_] > place]
            if not len(open_):
                break
            codes = self.codes[self.first[open_] + self.lengths[open_] - 1 - place]
            new[open_] = costs_before(new[open_], codes)
            old[open_] = costs_before(old[open_], codes)
        return self.restore(front), self.restore(shift)

    def forward(self, costs: np.ndarray, enter: np.ndarray, last: np.ndarray):
        """The least edits from the states ``enter``: (state behind, inserts, state, edit per slot).

        ``inserts`` are made in front of a slot's row, from ``state`` on. ``last`` says which chunks
        end their conversation and are completed.
        """
        slot, state = self.slots(), enter[self.order].copy()
        n_slots = len(costs)
        inserts = np.zeros(n_slots, np.int64)
        entered = np.zeros(n_slots, np.int64)
        edit = np.full(n_slots, -1)
        ends = last[self.order]
        for place in range(self.longest + 1):
            n = self.active(place)
            at = slot[:n] + place
            entered[at] = state[:n]
            here = costs[at]
            behind = np.concatenate([costs[at + 1], np.full((n, 1), _NEVER)], axis=1)
            code = self.codes[self.first[:n] + place]
            kind, status = code & 3, code >> 2
            leave = np.where(status == CUT, TRUNCATED, 0)
            row = np.arange(n)
            for _ in range(2):
                now = here[row, state[:n]]
                drop = DELETE + behind[row, state[:n]] == now
                put = ~drop & (INSERT + here[row, _WRITE[state[:n]]] == now)
                inserts[at] += put
                state[:n] = np.where(put, _WRITE[state[:n]], state[:n])
            now = here[row, state[:n]]
            drop = DELETE + behind[row, state[:n]] == now
            after = _KEEP[kind, state[:n]]
            keep = ~drop & (status < BLANK) & (leave + behind[row, after] == now)
            written = _WRITE[state[:n]]
            edit[at] = np.where(drop, 0, np.where(keep, 1, written))
            state[:n] = np.where(drop, state[:n], np.where(keep, after, written))
            # Chunks whose rows end here.
            over = np.arange(n, self.active(place - 1)) if place else np.arange(n, len(slot))
            over = over[ends[over]]
            tail = slot[over] + place
            entered[tail] = state[over]
            inserts[tail] = END[state[over]] // INSERT
        return self.restore(state), inserts, entered, edit


def chunk_blocks(batch: pa.RecordBatch, name: str = "symbols"):
    """(first row, last row, chunks) of a batch, few enough symbols at a time."""
    data, starts = column_bytes(batch.column(batch.schema.get_field_index(name)))
    for first, last in blocks(starts, BLOCK_SYMBOLS):
        at = starts[first : last + 1]
        yield first, last, Chunks(data[at[0] : at[-1]], at - at[0])


def _numbers(batch: pa.RecordBatch, name: str, first: int, last: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name)).slice(first, last - first)
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _columns(batch: pa.RecordBatch, names: list[str], first: int, last: int) -> list:
    return [batch.column(batch.schema.get_field_index(n)).slice(first, last - first) for n in names]


def ordered_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) in one order, with ``at``, their place in it.

    The rows of a conversation are neighbours: by turn (nulls first), then role, then the text's md5.
    Null roles and texts are empty. ``at`` is the partition and the place in it; rows of one
    conversation in one partition have consecutive numbers.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        text.alias("text"),
        F.unhex(F.md5(text)).alias("name"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv_id", "turn", "role", "name", "tie"]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return placed.withColumn("at", F.monotonically_increasing_id())


def chunk_table(ordered: DataFrame, chunk_bits: int) -> DataFrame:
    """conv_id, id (its first row's place) and symbols, a letter per row for initial and status."""
    facts = ordered.select(
        "conv_id",
        "at",
        "role",
        "name",
        (~F.col("text").rlike(_WORD)).alias("blank"),
        (~F.col("text").rlike(_WHOLE)).alias("cut"),
    )
    # Of equal rows the first stays; it is found by its place, so copies never meet in bulk.
    firsts = facts.groupBy("conv_id", "role", "name").agg(F.min("at").alias("first"))
    known = facts.join(firsts.select("first"), F.col("at") == F.col("first"), "left")
    status = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("first").isNull(), DUPLICATE)
        .when(F.col("cut"), CUT)
        .otherwise(FINE)
    )
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.char(F.lit(ord("a")) + kind + 4 * status)
    grouped = known.select("conv_id", "at", symbol.alias("symbol")).groupBy(
        "conv_id", F.shiftright("at", chunk_bits).alias("chunk")
    )
    inside = F.array_sort(F.collect_list(F.struct("at", "symbol")))
    return grouped.agg(inside.alias("rows")).select(
        "conv_id",
        F.col("rows")[0]["at"].alias("id"),
        F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"),
    )


def speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first pass: each chunk from the end's vector; and what its rows show by themselves."""
    for batch in batches:
        for first, last, chunks in chunk_blocks(batch):
            n = last - first
            start = np.full(n, END_SHAPE)
            costs = chunks.backward(start)
            back = np.argsort(chunks.order)
            begin, size = chunks.first[back], chunks.lengths[back]
            owner = np.repeat(np.arange(n), size)
            kind, status = chunks.codes & 3, chunks.codes >> 2
            wrong = ~_LEGAL[kind[:-1], kind[1:]] & (owner[:-1] == owner[1:])
            counts = [np.bincount(owner[:-1][wrong], minlength=n)]
            counts += [np.bincount(owner[status == s], minlength=n) for s in (BLANK, DUPLICATE, CUT)]
            facts = [*counts, kind[begin], kind[begin + size - 1]]
            run = [start, pack(costs), costs.min(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [*_columns(batch, ["conv_id", "id"], first, last), *map(pa.array, [*facts, *run])],
                names=["conv_id", "id", "illegal", "blank", "duplicate", "truncated", "head", "tail",
                       "start", "front", "shift"],
            )


def fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks again, from the shape that their neighbour wants."""
    for batch in batches:
        for first, last, chunks in chunk_blocks(batch):
            wanted, *before = (_numbers(batch, c, first, last) for c in ("wanted", "start", "front", "shift"))
            front, shift = chunks.rerun(wanted, *before)
            yield pa.RecordBatch.from_arrays(
                [*_columns(batch, ["conv_id", "id"], first, last), *map(pa.array, (wanted, front, shift))],
                names=["conv_id", "id", "start", "front", "shift"],
            )


def stitch_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which vector each chunk has to start from, from the last chunk of a conversation on.

    Rows are a chunk's runs, chunks in descending order. ``known`` says whether there is a run from
    that vector; if not, its first run is a guess at what comes out.
    """
    conv, chunk, wanted, runs = object(), None, END_SHAPE, {}
    guess = None
    for batch in batches:
        found = []
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for c, i, start, front, shift in zip(*columns):
            if c != conv or i != chunk:
                if chunk is not None:
                    found.append((chunk, wanted, wanted in runs))
                    wanted = runs.get(wanted, guess)
                if c != conv:
                    conv, wanted = c, END_SHAPE
                chunk, runs, guess = i, {}, front
            runs[start] = front
        if found:
            yield _rows(found, ("id", "wanted", "known"))
    if chunk is not None:
        yield _rows([(chunk, wanted, wanted in runs)], ("id", "wanted", "known"))


def stitch_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which the edits come to each chunk; rows are chunks in ascending order."""
    conv, state = object(), 0
    for batch in batches:
        found = []
        for c, i, ways in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if c != conv:
                conv, state = c, 0
            found.append((i, state))
            state = (ways >> (4 * state)) & 15
        if found:
            yield _rows(found, ("id", "enter"))


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=list(names))


def ways_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk the state behind it for each state in front, four bits each."""
    for batch in batches:
        for first, last, chunks in chunk_blocks(batch):
            n = last - first
            costs = np.empty((len(chunks.codes) + n, 4), np.int64)
            chunks.backward(_numbers(batch, "wanted", first, last), costs)
            ways = np.zeros(n, np.int64)
            for state in range(4):
                behind, *_ = chunks.forward(costs, np.full(n, state), np.zeros(n, bool))
                ways |= behind << (4 * state)
            yield pa.RecordBatch.from_arrays(
                [*_columns(batch, ["conv_id", "id"], first, last), pa.array(ways)],
                names=["conv_id", "id", "ways"],
            )


def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's plan, a letter per edit, and its steps (at, n, edit); n orders those of a row."""
    for batch in batches:
        for first, last, chunks in chunk_blocks(batch):
            n = last - first
            costs = np.empty((len(chunks.codes) + n, 4), np.int64)
            chunks.backward(_numbers(batch, "wanted", first, last), costs)
            ends = _numbers(batch, "last", first, last).astype(bool)
            _, inserts, entered, edit = chunks.forward(costs, _numbers(batch, "enter", first, last), ends)
            back = np.argsort(chunks.order)
            slots = chunks.lengths[back] + 1
            begin = np.cumsum(slots) - slots
            owner = np.repeat(np.arange(n), slots)
            place = np.arange(len(owner)) - begin[owner]
            behind = edit < 0
            at = _numbers(batch, "id", first, last)[owner] + place - behind
            each = inserts + ~behind
            slot = np.repeat(np.arange(len(owner)), each)
            k = np.arange(len(slot)) - np.repeat(np.cumsum(each) - each, each)
            put = k < inserts[slot]
            # Inserted rows alternate, beginning with what may follow the state.
            role = ((_WRITE[entered[slot]] - USER) + k) % 2
            letters = _PLAN[np.where(put, 4 + role, edit[slot])]
            number = np.where(behind[slot], 3 + k, np.where(put, k, 2))
            edges = np.concatenate([[0], np.cumsum(np.bincount(owner, each, n).astype(np.int64))])
            edges = pa.array(edges.astype(np.int32))
            one = np.arange(len(slot) + 1, dtype=np.int32)
            steps = pa.StructArray.from_arrays(
                [
                    pa.array(at[slot]),
                    pa.array(number.astype(np.int32)),
                    pa.StringArray.from_buffers(len(slot), pa.py_buffer(one), pa.py_buffer(letters)),
                ],
                names=["at", "n", "edit"],
            )
            plan = pa.StringArray.from_buffers(n, edges.buffers()[1], pa.py_buffer(letters))
            yield pa.RecordBatch.from_arrays(
                [*_columns(batch, ["conv_id", "id"], first, last), plan, pa.ListArray.from_arrays(edges, steps)],
                names=["conv_id", "id", "plan", "steps"],
            )


def converge(chunks: DataFrame, runs: DataFrame, keep) -> tuple[DataFrame, int]:
    """Fix-up passes: (id, wanted, front, shift) of chunks that meet their neighbours, and the passes.

    ``runs`` has conv_id, id, start, front and shift of the first pass.
    """
    tried, passes = runs.select("conv_id", "id", "start", "front", "shift"), 0
    while True:
        walked = (
            tried.repartition("conv_id")
            .sortWithinPartitions("conv_id", F.desc("id"))
            .mapInArrow(stitch_back, "id long, wanted long, known boolean")
        )
        walked = keep(walked, "walked")
        missing = walked.where(~F.col("known")).select("id", "wanted")
        if missing.isEmpty():
            met = F.col("w.wanted") == F.col("t.start")
            ready = walked.alias("w").join(tried.alias("t"), (F.col("w.id") == F.col("t.id")) & met)
            return ready.select("w.id", "wanted", "front", "shift"), passes
        passes += 1
        again = (
            chunks.join(missing, "id")
            .join(runs.select("id", "start", "front", "shift"), "id")
            .mapInArrow(fix_up, _with_key(runs, "id long, start long, front long, shift long"))
        )
        tried = tried.unionByName(keep(again, "fix-up"))


def _with_key(df: DataFrame, rest: str) -> str:
    return f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {rest}"


class Repair:
    """The repair of all conversations of ``rows`` (conv_id, turn, role, text), as tables.

    ``ordered``: the rows, with their place ``at``. ``chunks``: conv_id, id, illegal, blank,
    duplicate, truncated (counts) and cost (of the chunk, to be summed). ``plans``: conv_id, id, plan.
    ``passes``: fix-up passes that were needed. Null conv_ids are one conversation. Null roles and
    texts are empty; a text without a word is blank. Extra columns are ignored; an empty table gives
    empty tables.
    """

    def __init__(self, rows: DataFrame, chunk_bits: int = CHUNK_BITS):
        self.work = Scratch(rows.sparkSession)
        keep = self.work.keep
        self.ordered = keep(ordered_rows(rows), "ordered")
        symbols = keep(chunk_table(self.ordered, chunk_bits), "chunks")
        first_pass = symbols.mapInArrow(
            speculate,
            _with_key(
                symbols,
                "id long, illegal long, blank long, duplicate long, truncated long, head long, "
                "tail long, start long, front long, shift long",
            ),
        )
        first_pass = keep(first_pass, "first-pass")
        in_order = Window.partitionBy("conv_id").orderBy("id")
        legal = F.lag("tail").over(in_order) * 4 + F.col("head")
        border = legal.isNotNull() & ~legal.isin([int(4 * a + b) for a, b in np.argwhere(_LEGAL)])
        linked = keep(
            first_pass.select(
                "*",
                border.cast("long").alias("border"),
                F.lag("id").over(in_order).isNull().alias("first"),
                F.lead("id").over(in_order).isNull().alias("last"),
            ),
            "linked",
        )
        several = linked.where(~(F.col("first") & F.col("last")))
        parts = symbols.join(several.select("id"), "id", "left_semi")
        met, self.passes = converge(parts, several, keep)
        met = keep(met, "met")
        ways = keep(
            parts.join(met.select("id", "wanted"), "id").mapInArrow(
                ways_through, _with_key(symbols, "id long, ways long")
            ),
            "ways",
        )
        enter = (
            ways.repartition("conv_id")
            .sortWithinPartitions("conv_id", "id")
            .mapInArrow(stitch_forward, "id long, enter long")
        )
        whole = linked.where(F.col("first") & F.col("last"))
        begin = whole.select(
            "id", F.col("start").alias("wanted"), "front", "shift", F.lit(0).cast("long").alias("enter")
        ).unionByName(met.join(enter, "id"))
        begin = keep(begin.join(linked.select("id", "first", "last"), "id"), "begin")
        traced = (
            symbols.join(begin, "id")
            .select("conv_id", "id", "symbols", "wanted", "enter", F.col("last").cast("long").alias("last"))
            .mapInArrow(
                trace,
                _with_key(symbols, "id long, plan string, steps array<struct<at:long,n:int,edit:string>>"),
            )
        )
        self.traced = keep(traced, "traced")
        self.plans = self.traced.select("conv_id", "id", "plan")
        costs = begin.select(
            "id", (F.col("shift") + F.when(F.col("first"), F.col("front").bitwiseAND(F.lit(15))).otherwise(0)).alias("cost")
        )
        self.chunks = linked.select(
            "conv_id", "id", (F.col("illegal") + F.col("border")).alias("illegal"),
            "blank", "duplicate", "truncated",
        ).join(costs, "id")

    def rows(self) -> DataFrame:
        """The repaired rows: conv_id, at, n (their order), edit, turn, role, text.

        An inserted row has no turn and an empty text; ``at`` is the row that it stands before or, at a
        conversation's end, behind.
        """
        steps = self.traced.select("conv_id", F.inline("steps")).where(F.col("edit") != "D")
        put = F.col("edit").isin("u", "a")
        name = F.when(F.lower("edit") == "u", F.lit("user")).otherwise(F.lit("assistant"))
        inserted = steps.where(put).select(
            "conv_id", "at", "n", F.lit("I").alias("edit"),
            F.lit(None).cast(self.ordered.schema["turn"].dataType).alias("turn"),
            name.alias("role"), F.lit("").alias("text"),
        )
        stays = F.col("edit") == "K"
        kept = (
            steps.where(~put)
            .drop("conv_id")
            .join(self.ordered, "at")
            .select(
                "conv_id", "at", "n", F.when(stays, F.lit("K")).otherwise(F.lit("R")).alias("edit"),
                "turn", F.when(stays, F.col("role")).otherwise(name).alias("role"), "text",
            )
        )
        return kept.unionByName(inserted)

    def audits(self) -> DataFrame:
        """conv_id and audit: the initials of all edits in order, one letter each."""
        parts = F.array_sort(F.collect_list(F.struct("id", "plan")))
        joined = F.array_join(F.transform(parts, lambda p: p["plan"]), "")
        return self.plans.groupBy("conv_id").agg(F.translate(joined, "UAua", "RRII").alias("audit"))

    def finish(self, *results: DataFrame) -> list[DataFrame]:
        """Results, written; the tables of the repair are deleted."""
        return self.work.finish(*results)


def digests(rows: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, of the ``role:text`` of its rows, joined by line feeds.

    A digest is made from front to back, so a conversation's rows pass one task, a batch at a time.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, done = object(), None, []
        for batch in batches:
            data, starts = column_bytes(batch.column(1))
            for c, a, b in zip(batch.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                if state is None or c != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                    a += 1  # no line feed in front of the first row
                state.update(data[a:b])
            if done:
                yield _keyed(done, batch.schema.field(0).type)
                done = []
        if state is not None:
            yield _keyed([(conv, state.hexdigest())], batch.schema.field(0).type)

    piece = F.concat(F.lit("\n"), "role", F.lit(":"), "text").alias("piece")
    order = ["conv_id", "at", "n"]
    return (
        rows.select(*order, piece)
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "piece")
        .mapInArrow(scan, _with_key(rows, "repaired_sha256 string"))
    )


def _keyed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    keys, values = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, kind), pa.array(values)], names=["conv_id", "repaired_sha256"]
    )


def audit_report(rows: DataFrame, conversations: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Per conv_id of ``conversations``: the faults of its ``rows``, and their cheapest repair.

    Returns conv_id, gaps (turns missing between the least and the largest), blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256. Conversations without rows have zeros, an
    empty audit and the digest of nothing.
    """
    repair = Repair(rows, chunk_bits)
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = repair.ordered.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    sums = repair.chunks.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts])
    facts = gaps
    for more in (sums, repair.audits(), digests(repair.rows()), conversations.select("conv_id").distinct()):
        facts = facts.unionByName(more, allowMissingColumns=True)
    zero = F.lit(0).cast("long")
    nothing = hashlib.sha256(b"").hexdigest()
    report = facts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), zero).alias(c) for c in ("gaps", *counts)],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )
    return repair.finish(report)[0]
