"""Repeated substrings of bytes, by sparse distributed prefix doubling.

A byte is repeated if a string of ``THRESHOLD`` bytes that covers it also starts elsewhere. Sorting
all suffixes by ranks of ever longer prefixes decides that, but every byte would be a row in every
round. Here the rounds run over sampled places first and over single starts only where needed:

* Each start belongs to an anchor: the place, among those in front of the string's last ``CORE``
  bytes, whose ``GRAM`` bytes have the least hash. Equal strings have their anchor at the same
  place, and neighbouring starts share it, so an anchor stands for an interval of starts.
* Round 1 ranks anchors by their first CORE bytes. Ranks are names (hashes of the bytes), so the
  rank of a longer string is made of a pair of ranks without a join. Anchors whose rank is unique
  are done: none of their strings is repeated. Then the pair of this rank and the rank of
  everything the interval's strings cover is compared: where two anchors agree, all starts of the
  interval are repeated, and done.
* What stays open is cut into blocks of ever fewer starts (``BLOCKS``). A round compares what all
  strings of a block have in common, which grows from round to round up to the whole string: a
  unique rank means no repeat, an equal rank of all that the block covers means repeats
  throughout, and only blocks between the two go on. The last round has single starts and whole
  strings. Classes that are equal as a whole send one member to these rounds.

Every round is an aggregation of rank pairs, combined before it is shuffled, so a passage in a
third of all documents is one class after its first round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.arrays import Rolling, blocks, column_bytes, mix, ranges, signed, text_blocks
from tickhouse.llm.scratch import Scratch

THRESHOLD = 200
CORE = 48
GRAM = 16
BLOCKS = (32, 8, 1)
_PLACE = np.uint64((1 << 30) - 1)

TEXTS = (
    "doc_id long, n_bytes long, sha string, text_name long, "
    "items array<struct<spot:long,core:long,span:long>>"
)


def slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each window of ``width`` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    padded = padded.reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(data: np.ndarray, starts: np.ndarray, threshold: int, core: int):
    """The anchors of a block of texts: text, first start, starts, lead (anchor - first start), names."""
    n = len(data)
    if n < threshold:
        return [np.empty(0, np.int64)] * 6
    rolling, other = Rolling(data, 1), Rolling(data, 5)
    gram = GRAM
    hashes = (rolling.prefix[gram:] - rolling.prefix[:-gram]) * rolling.inverse[: n - gram + 1]
    keys = (hashes & ~_PLACE) | np.arange(n - gram + 1, dtype=np.uint64)
    least = slide_min(keys[: n - core + 1], threshold - core + 1)
    end = np.repeat(starts[1:], np.diff(starts))
    start = np.flatnonzero(np.arange(n - threshold + 1) + threshold <= end[: n - threshold + 1])
    if not len(start):
        return [np.empty(0, np.int64)] * 6
    at = (least[start] & _PLACE).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    first, at = start[cut], at[cut]
    size = np.diff(np.append(cut, len(start)))
    text = np.searchsorted(starts, first, "right") - 1
    core_name = rolling.between(at, at + core)
    span = other.between(first, first + size - 1 + threshold)
    span_name = mix(span + (at - first).astype(np.uint64))
    return [text, first - starts[text], size, at - first, signed(core_name), signed(span_name)]


def unpacked(name: str) -> Column:
    """first (start), starts or lead of a spot."""
    spot = F.col("spot")
    return {
        "first": F.shiftright(spot, 32),
        "starts": F.shiftright(spot, 16).bitwiseAND(F.lit(0xFFFF)),
        "lead": spot.bitwiseAND(F.lit(0xFFFF)),
    }[name].cast("long")


def text_table(docs: DataFrame, threshold: int, core: int) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, sha, text_name and its anchors."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                shas = [hashlib.sha256(data[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                text, *columns = anchors(data, starts, threshold, core)
                first_start, size, lead, core_name, span_name = columns
                # One number holds where an anchor is; see unpacked().
                spot = (first_start << 32) | (size << 16) | lead
                items = pa.StructArray.from_arrays(
                    [pa.array(c, pa.int64()) for c in (spot, core_name, span_name)],
                    names=["spot", "core", "span"],
                )
                edges = np.searchsorted(text, np.arange(last - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.diff(starts)),
                        pa.array([s.hexdigest() for s in shas], pa.string()),
                        pa.array([int.from_bytes(s.digest()[:8], "big", signed=True) for s in shas], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(edges), items),
                    ],
                    names=["doc_id", "n_bytes", "sha", "text_name", "items"],
                )

    return docs.select("doc_id", "text").mapInArrow(make, TEXTS)


def region_table(docs: DataFrame, wanted: DataFrame, threshold: int) -> DataFrame:
    """The bytes around anchors: place, text_name, anchor (its place in the text), low, starts, bytes.

    ``wanted`` has doc_id, sha and items (place, first, starts, lead) of the texts to read.
    """
    # Rows that share a doc_id, or have none, meet by their texts.
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.sha2("text", 256) == F.col("sha"))
    texts = docs.select("doc_id", "text").join(wanted.withColumnRenamed("doc_id", "rep"), same)
    kept = ("place", "first", "starts", "lead")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = column_bytes(batch.column(0))
            for i, a in enumerate(starts[:-1]):
                items = batch.column(2)[i].values
                place, first, size, lead = (
                    items.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in kept
                )
                whole = size - 1 + threshold
                cut = data[a + ranges(first, whole)]
                offsets = np.concatenate([[0], np.cumsum(whole)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place),
                        pa.array(np.full(len(place), batch.column(1)[i].as_py())),
                        pa.array(first + lead),
                        pa.array(-lead),
                        pa.array(size),
                        pa.Array.from_buffers(
                            pa.binary(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(cut)]
                        ),
                    ],
                    names=["place", "text_name", "anchor", "low", "starts", "bytes"],
                )

    return (
        texts.select("text", "text_name", "items")
        .mapInArrow(make, "place long, text_name long, anchor long, low long, starts long, bytes binary")
        .dropDuplicates(["place"])
    )


def block_ranks(regions: DataFrame, size: int, threshold: int) -> DataFrame:
    """Blocks of ``size`` starts within the open intervals of ``regions``.

    ``regions`` has place, low, bytes and open (intervals [from, to] of starts around the anchor).
    Returns place, from, to, common (rank of what all strings of the whole block share) and covered
    (rank of all that its strings cover here).
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = column_bytes(batch.column(2))
            low = batch.column(1).to_numpy()
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy()
            values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            begin = values.field("from").to_numpy(zero_copy_only=False)
            until = values.field("to").to_numpy(zero_copy_only=False)
            for a, b in blocks(starts):
                mine = np.flatnonzero((owner >= a) & (owner < b))
                if not len(mine):
                    continue
                piece = data[starts[a] : starts[b]]
                one, two = Rolling(piece, 1), Rolling(piece, 5)
                first_block = begin[mine] // size
                count = until[mine] // size - first_block + 1
                row = np.repeat(mine, count)
                block = ranges(first_block, count)
                x = np.maximum(begin[row], block * size)
                y = np.minimum(until[row], block * size + size - 1)
                # Where start 0 (the anchor) of this region lies in the piece.
                zero = starts[owner[row]] - starts[a] - low[owner[row]]
                common = one.between(zero + block * size + size - 1, zero + block * size + threshold)
                covered = two.between(zero + x, zero + y + threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner[row])),
                        pa.array(x),
                        pa.array(y),
                        pa.array(signed(mix(common + block.astype(np.uint64)))),
                        pa.array(signed(mix(mix(covered + x.astype(np.uint64)) + y.astype(np.uint64)))),
                    ],
                    names=["place", "from", "to", "common", "covered"],
                )

    return regions.select("place", "low", "bytes", "open").mapInArrow(
        make, "place long, from long, to long, common long, covered long"
    )


def rank_classes(rows: DataFrame, rank: str, whole: str) -> DataFrame:
    """The classes of rows that agree in a rank and the rank of the whole.

    Returns rank, whole, least (the class's first place) and repeated (it has another place).
    """
    classes = rows.groupBy(rank, whole).agg(F.min("place").alias("least"), F.max("place").alias("last"))
    return classes.select(rank, whole, "least", (F.col("least") < F.col("last")).alias("repeated"))


def open_ranks(classes: DataFrame, rank: str) -> DataFrame:
    """Ranks that hold several classes, some of a single place: longer prefixes must decide."""
    return (
        classes.groupBy(rank)
        .agg(F.count("*").alias("kinds"), F.min("repeated").alias("all_repeated"))
        .where((F.col("kinds") > 1) & ~F.col("all_repeated"))
        .select(rank)
    )


def repeated_starts(
    docs: DataFrame, table: DataFrame, threshold: int, work: Scratch
) -> tuple[DataFrame, DataFrame]:
    """(texts, starts): ``table`` without its anchors, and the intervals of repeated starts.

    starts has text_name, from and to (places in the text). A table is deleted after its last reader,
    ``table`` too.
    """
    keep = work.keep
    items = table.select("text_name", F.inline("items"))
    place = F.xxhash64("text_name", "spot").alias("place")
    ranks = items.select("core", place)
    # Written, because Spark splits a hot rank's rows only where both sides of a join are shuffled.
    known = keep(
        ranks.groupBy("core")
        .agg(F.min("place").alias("least"), F.max("place").alias("last"))
        .where(F.col("least") < F.col("last"))
        .select("core"),
        "shared-cores",
    )
    shared = keep(items.join(known, "core").select("*", place), "shared-anchors")
    texts = keep(table.drop("items"), "texts")
    work.free(known, table)
    classes = keep(rank_classes(shared, "core", "span"), "anchor-classes")
    done = keep(
        shared.join(classes.where("repeated").select("core", "span"), ["core", "span"]).select(
            "text_name",
            unpacked("first").alias("from"),
            (unpacked("first") + unpacked("starts") - 1).alias("to"),
        ),
        "whole-anchors",
    )
    members = classes.join(open_ranks(classes, "core"), "core").select(
        "core", "span", F.col("least").alias("place"), "repeated"
    )
    members = keep(
        shared.join(members, ["core", "span", "place"]).select("text_name", "place", "spot", "repeated"),
        "open-anchors",
    )
    work.free(shared, classes)
    reps = texts.groupBy("text_name").agg(F.min(F.struct("sha", "doc_id")).alias("rep"))
    wanted = (
        members.groupBy("text_name")
        .agg(
            F.collect_set(
                F.struct("place", *[unpacked(n).alias(n) for n in ("first", "starts", "lead")])
            ).alias("items")
        )
        .join(reps, "text_name")
        .select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.sha").alias("sha"), "text_name", "items")
    )
    regions = keep(region_table(docs, wanted, threshold), "regions")
    single = keep(members.where(~F.col("repeated")).select("place").distinct(), "single")
    work.free(members)
    intervals = regions.select(
        "place",
        F.array(
            F.struct(F.col("low").alias("from"), (F.col("low") + F.col("starts") - 1).alias("to"))
        ).alias("open"),
    )
    found = []
    for size in BLOCKS:
        rows = keep(block_ranks(regions.join(intervals, "place"), size, threshold), f"blocks-{size}")
        classes = keep(rank_classes(rows, "common", "covered"), f"classes-{size}")
        repeated = (
            rows.join(classes.where("repeated").select("common", "covered"), ["common", "covered"])
            .join(single, "place", "left_semi")
            .select("place", "from", "to")
        )
        found.append(keep(repeated, f"found-{size}"))
        if size > 1:
            kept = classes.join(open_ranks(classes, "common"), "common").select(
                "common", "covered", F.col("least").alias("place")
            )
            intervals = keep(
                rows.join(kept, ["common", "covered", "place"])
                .groupBy("place")
                .agg(F.collect_set(F.struct("from", "to")).alias("open")),
                f"open-{size}",
            )
        work.free(rows, classes)
    blocks_done = found[0]
    for more in found[1:]:
        blocks_done = blocks_done.union(more)
    placed = blocks_done.join(regions.select("place", "text_name", "anchor"), "place").select(
        "text_name",
        (F.col("anchor") + F.col("from")).alias("from"),
        (F.col("anchor") + F.col("to")).alias("to"),
    )
    placed = keep(placed, "placed")
    work.free(regions, *found)
    return texts, done.union(placed)


def removed_spans(docs: DataFrame, threshold: int = THRESHOLD, core: int = CORE) -> tuple[DataFrame, DataFrame]:
    """(texts, spans) of ``docs`` (doc_id, text).

    texts: doc_id, n_bytes, sha, text_name and copies (rows with this text) of every row. spans:
    text_name and spans, the maximal runs [from, to) of repeated bytes of every text that has any.
    Rows with equal texts repeat each other wholly if they have ``threshold`` bytes.
    """
    if not GRAM <= core <= threshold < 1 << 16:
        raise ValueError(f"core must be from {GRAM} to the threshold, which must be below 65536")
    work = Scratch(docs.sparkSession)
    table = work.keep(text_table(docs, threshold, core), "anchors")
    texts, starts = repeated_starts(docs, table, threshold, work)
    copies = texts.groupBy("text_name").agg(
        F.count("*").alias("copies"), F.max("n_bytes").alias("size")
    )
    partly = starts.groupBy("text_name").agg(
        F.collect_list(F.struct(F.col("from"), (F.col("to") + threshold).alias("to"))).alias("found")
    )
    whole = (F.col("copies") > 1) & (F.col("size") >= threshold)
    merged = merge_spans(F.col("found"))
    spans = (
        copies.join(partly, "text_name", "left")
        .where(whole | F.col("found").isNotNull())
        .select(
            "text_name",
            F.when(
                whole, F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("size").alias("to")))
            )
            .otherwise(merged)
            .alias("spans"),
        )
    )
    texts, spans = work.finish(texts, spans)
    return texts, spans


def merge_spans(found):
    """Overlapping or touching intervals of an array joined."""
    return F.aggregate(
        F.array_sort(found),
        F.expr("cast(array() as array<struct<from:bigint,to:bigint>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["to"] >= x["from"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["from"].alias("from"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["to"], x["to"]).alias("to"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


def cut_spans(texts: DataFrame, whole_characters: bool = False) -> DataFrame:
    """Applies ``spans`` to ``text`` of each row: adds kept (bytes), n_removed and n_spans.

    ``texts`` has text, spans and other columns; null spans remove nothing, spans are disjoint and
    ascending. With ``whole_characters``, a character of which a byte is removed goes as a whole, so
    that what is kept is text. The text is dropped.
    """
    others = [c for c in texts.columns if c not in ("text", "spans", "kept", "n_removed", "n_spans")]
    source = texts.select("text", "spans", *[F.col(f"`{c}`") for c in others])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = column_bytes(batch.column(0))
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            flat = lists.values
            begin = flat.field("from").to_numpy(zero_copy_only=False)
            until = flat.field("to").to_numpy(zero_copy_only=False)
            real = np.asarray(lists.is_valid())
            count = np.where(real, np.diff(offsets), 0)
            span = ranges(offsets[:-1].astype(np.int64), count)
            shift = np.repeat(starts[:-1], count)
            change = np.zeros(len(data) + 1, np.int32)
            np.add.at(change, begin[span] + shift, 1)
            np.add.at(change, until[span] + shift, -1)
            keep = np.cumsum(change[:-1]) == 0
            if whole_characters:
                character = np.cumsum((data & 0xC0) != 0x80) - 1
                broken = np.zeros(len(data) + 1, bool)
                broken[character[~keep]] = True
                keep = ~broken[character]
            left = np.concatenate([[0], np.cumsum(keep)])[starts]
            kept = pa.Array.from_buffers(
                pa.large_binary(),
                batch.num_rows,
                [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[keep]))],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[2:],
                    kept.cast(pa.binary()),
                    pa.array(np.diff(starts) - np.diff(left)),
                    pa.array(count.astype(np.int64)),
                ],
                names=[*others, "kept", "n_removed", "n_spans"],
            )

    fields = [texts.schema[c] for c in others]
    schema = T.StructType(
        [
            *fields,
            T.StructField("kept", T.BinaryType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
        ]
    )
    return source.mapInArrow(cut, schema)


def removal_report(docs: DataFrame, threshold: int = THRESHOLD, core: int = CORE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Bytes are those of the whole UTF-8 text (null: none); a byte is removed if a string of
    ``threshold`` bytes that covers it also starts anywhere else, in the same text or another;
    n_spans counts maximal removed runs, and kept_sha256 is of the other bytes, concatenated. Texts
    below the threshold keep all. Repeated rows repeat each other. Extra columns are ignored; an
    empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts, spans = removed_spans(docs, threshold, core)
    nothing = hashlib.sha256(b"").hexdigest()
    size = F.col("n_bytes")
    partly = texts.join(spans, "text_name").where(
        ~((F.size("spans") == 1) & (F.col("spans")[0]["from"] == 0) & (F.col("spans")[0]["to"] == size))
    )
    reps = partly.groupBy("text_name").agg(
        F.min(F.struct("doc_id", "sha")).alias("rep"), F.max("spans").alias("spans")
    )
    read = docs.join(
        reps.select("text_name", F.col("rep.doc_id").alias("rep"), F.col("rep.sha").alias("sha"), "spans"),
        F.col("doc_id").eqNullSafe(F.col("rep")) & (F.sha2("text", 256) == F.col("sha")),
    )
    cut = (
        cut_spans(read.select("text", "spans", "text_name"))
        .select("text_name", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
        .dropDuplicates(["text_name"])
    )
    whole = spans.select("text_name", F.lit(True).alias("found"))
    return (
        texts.join(whole, "text_name", "left")
        .join(cut, "text_name", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(F.col("found").isNull(), F.lit(0).cast("long"))
            .otherwise(F.coalesce("n_removed", "n_bytes"))
            .alias("n_removed"),
            F.when(F.col("found").isNull(), F.lit(0).cast("long"))
            .otherwise(F.coalesce("n_spans", F.lit(1).cast("long")))
            .alias("n_spans"),
            F.when(F.col("found").isNull(), F.col("sha"))
            .otherwise(F.coalesce("kept_sha256", F.lit(nothing)))
            .alias("kept_sha256"),
        )
    )


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, core: int = CORE) -> DataFrame:
    """``docs`` (doc_id, text and others) with the repeated bytes taken out of ``text``.

    Characters of which only some bytes were removed are dropped whole. Rows that lose all of their
    text are left out; rows that had none stay. n_chars, where there is such a column, is
    counted anew; all other columns are returned as they are.
    """
    names = docs.columns
    mine = docs.toDF(*[f"_{i}" for i in range(len(names))])
    doc, text = (F.col(f"_{names.index(c)}") for c in ("doc_id", "text"))
    texts, spans = removed_spans(
        mine.select(doc.cast("long").alias("doc_id"), text.alias("text")), threshold, core
    )
    known = texts.join(spans, "text_name").select(F.col("doc_id").alias("of"), "sha", "spans")
    same = doc.cast("long").eqNullSafe(F.col("of")) & (F.col("name") == F.col("sha"))
    joined = mine.withColumn("name", F.sha2(F.coalesce(text, F.lit("")), 256)).join(
        known.distinct(), same, "left"
    )
    untouched = joined.where(F.col("spans").isNull()).select(*mine.columns)
    others = [c for c in mine.columns if c != f"_{names.index('text')}"]
    found = joined.where(F.col("spans").isNotNull()).select(text.alias("text"), "spans", *others)
    cut = cut_spans(found, whole_characters=True).withColumn(
        f"_{names.index('text')}", F.col("kept").cast("string")
    )
    rewritten = cut.where(F.length(text) > 0)
    if "n_chars" in names:
        counted = F.length(text).cast(docs.schema["n_chars"].dataType)
        rewritten = rewritten.withColumn(f"_{names.index('n_chars')}", counted)
    return untouched.unionByName(rewritten.select(*mine.columns)).toDF(*names)

