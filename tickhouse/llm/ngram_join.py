"""Exact Jaccard join of word n-gram sets, filtered under several global token orders.

1. Every text becomes the set of its distinct word n-grams (64-bit names). Equal sets are one set
   from here on.
2. A set can only link if few of its n-grams are its own alone. Of a quarter of all n-grams,
   chosen by name, those of a single set are counted, which rules out most sets.
3. The n-grams of the remaining sets are counted and each set is ordered three ways: rarest first,
   and by rarity class and two independent hashes. Two sets that reach the threshold share an
   n-gram in the prefix of each order, and at the first shared place enough of both is left.
4. Candidates of the first order are looked up per shared prefix n-gram, intersected with the
   other orders' prefixes, and verified by counting the intersection of the whole sets.

Groups of near copies would make all their pairs candidates. Only components are asked for, so each
n-gram's sets are first verified against one hub, the set with the fewest n-grams of its own.
Then only sets outside the hub's component are paired, with the sets of other components, which
is exact: two sets of one component need no link of their own any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.arrays import Rolling, lower, mix, signed, text_blocks, word_spans
from tickhouse.llm.components import components
from tickhouse.llm.scratch import Scratch

Keep = Callable[[DataFrame, str], DataFrame]

WORDS = 4
# Similarity of at least this many hundredths.
HUNDREDTHS = 85
# N-grams with names below this are the quarter that is counted first.
QUARTER = 1 << 62


def ngram_sets(data: np.ndarray, starts: np.ndarray, words: int = WORDS):
    """The distinct n-grams of each text: (names ascending per text, how many, name of the set).

    A text with fewer words has its whole sequence as the only n-gram; without words, none.
    """
    data = lower(data)
    first, end, per_text = word_spans(data, starts)
    texts = len(per_text)
    hashes = Rolling(data, 1).between(first, end)
    rolling = Rolling(hashes, 2)
    before = np.cumsum(per_text) - per_text
    short = np.flatnonzero((per_text > 0) & (per_text < words))
    names = [rolling.between(before[short], before[short] + per_text[short])]
    owners = [short]
    if len(hashes) >= words:
        owner = np.repeat(np.arange(texts), per_text)
        inside = owner[: len(owner) - words + 1] == owner[words - 1 :]
        names.append(rolling.windows(words)[inside])
        owners.append(owner[: len(inside)][inside])
    name, owner = np.concatenate(names), np.concatenate(owners)
    order = np.lexsort((name, owner))
    name, owner = name[order], owner[order]
    if len(name):
        fresh = np.r_[True, (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])]
        name, owner = name[fresh], owner[fresh]
    counts = np.bincount(owner, minlength=texts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(name + np.uint64(77)))])
    edges = np.concatenate([[0], np.cumsum(counts)])
    whole = mix(sums[edges[1:]] - sums[edges[:-1]] + counts.astype(np.uint64))
    return name, counts, whole


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def set_table(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (size of the set), sid (its name) and low (its n-grams of the counted quarter).

    Columns of ``docs`` other than doc_id and text are carried along.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    source = docs.select("doc_id", "text", *others)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                name, counts, whole = ngram_sets(data, starts, words)
                low = name < np.uint64(QUARTER)
                owner = np.repeat(np.arange(len(counts)), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(counts.astype(np.int64)),
                        pa.array(signed(whole), mask=counts == 0),
                        _lists(signed(name[low]), np.bincount(owner[low], minlength=len(counts))),
                        *batch.slice(first, last - first).columns[2:],
                    ],
                    names=["doc_id", "n", "sid", "low", *others],
                )

    schema = T.StructType.fromDDL("doc_id long, n long, sid long, low array<long>")
    for c in others:
        schema.add(source.schema[c])
    return source.mapInArrow(make, schema)


def full_sets(docs: DataFrame, alive: DataFrame, words: int) -> DataFrame:
    """sid, n and grams of the sets in ``alive`` (sid, and a document that has it: rep, rep_text).

    A document is found by its doc_id and its text's hash, because many may share a doc_id or have
    none. Neither side has a bound, so the join is always by shuffle and behaves alike at every size.
    """
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("rep_text"))
    texts = docs.select("doc_id", "text").join(alive.select("rep", "rep_text", "sid").hint("merge"), same)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                name, counts, whole = ngram_sets(data, starts, words)
                wanted = batch.column(1).slice(first, last - first).to_numpy(zero_copy_only=False)
                keep = signed(whole) == wanted
                rows = pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(whole)),
                        pa.array(counts.astype(np.int64)),
                        _lists(signed(name), counts),
                    ],
                    names=["sid", "n", "grams"],
                )
                yield rows.filter(pa.array(keep))

    made = texts.select("text", "sid").mapInArrow(make, "sid long, n long, grams array<long>")
    return made.dropDuplicates(["sid"])


def prefix_size(n: Column, hundredths: int) -> Column:
    """n less the fewest n-grams that a set of n must share, plus 1."""
    return n - F.ceil(n * hundredths / F.lit(100)).cast("long") + 1


def prefixes(full: DataFrame, hundredths: int, keep: Keep) -> DataFrame:
    """sid, n, own (n-grams of this set alone) and the rest of the prefixes: by_count, by_hash1/2.

    N-grams of one set come first in every order, so a prefix is ``own`` of them and what follows.
    Sets whose own n-grams fill the prefix cannot link and are left out.
    """
    rows = full.select("sid", "n", F.explode("grams").alias("gram"))
    # Written, because Spark splits a hot n-gram's rows only where both sides of a join are shuffled.
    counts = keep(
        rows.groupBy("gram").agg(F.count("*").alias("df")).where(F.col("df") > 1), "counts"
    )
    shared = rows.join(counts, "gram")
    grouped = shared.groupBy("sid", "n").agg(F.collect_list(F.struct("df", "gram")).alias("shared"))
    own = F.col("n") - F.size("shared")
    room = (prefix_size(F.col("n"), hundredths) - own).cast("int")

    def order(key):
        ranked = F.array_sort(F.transform("shared", lambda x: F.struct(*key(x), x["gram"].alias("gram"))))
        return F.transform(F.slice(ranked, F.lit(1), room), lambda x: x["gram"])

    def hashed(seed):
        return lambda x: (
            F.ceil(F.log2(x["df"])).alias("rarity"),
            F.xxhash64(x["gram"], F.lit(seed)).alias("hash"),
        )

    return grouped.where(room > 0).select(
        "sid",
        "n",
        own.alias("own"),
        order(lambda x: (x["df"].alias("df"), F.xxhash64(x["gram"]).alias("hash"))).alias("by_count"),
        order(hashed(1)).alias("by_hash1"),
        order(hashed(2)).alias("by_hash2"),
    )


def may_link(n1, rest1, n2, rest2, hundredths: int) -> Column:
    """Whether two sets can reach the threshold if what is left of them from here on is all they share."""
    return ((100 + hundredths) * F.least(rest1, rest2) >= hundredths * (n1 + n2)) & (
        100 * F.least(n1, n2) >= hundredths * F.greatest(n1, n2)
    )


def verified(pairs: DataFrame, orders: DataFrame, full: DataFrame, hundredths: int) -> DataFrame:
    """The pairs (a, b) that meet in the prefixes of the other orders and reach the threshold."""
    keys = orders.select("sid", "by_hash1", "by_hash2")
    met = (
        pairs.join(keys.toDF("a", "a1", "a2"), "a")
        .join(keys.toDF("b", "b1", "b2"), "b")
        .where(F.arrays_overlap("a1", "b1") & F.arrays_overlap("a2", "b2"))
        .select("a", "b")
    )
    grams = full.select("sid", "n", "grams")
    both = F.size(F.array_intersect("ga", "gb")).cast("long")
    return (
        met.join(grams.toDF("a", "na", "ga"), "a")
        .join(grams.toDF("b", "nb", "gb"), "b")
        .select("a", "b", "na", "nb", both.alias("both"))
        .where(100 * F.col("both") >= hundredths * (F.col("na") + F.col("nb") - F.col("both")))
        .select("a", "b")
    )


def set_links(full: DataFrame, hundredths: int, keep: Keep) -> DataFrame:
    """Links (a, b) between the sets of ``full`` whose components are those of all links."""
    orders = keep(prefixes(full, hundredths, keep), "prefixes")
    postings = orders.select(
        "sid", "n", (F.col("own") / F.col("n")).alias("alone"), "own", F.posexplode("by_count").alias("pos", "gram")
    ).withColumn("rest", F.col("n") - F.col("own") - F.col("pos"))
    hubs = keep(
        postings.groupBy("gram")
        .agg(F.min(F.struct("alone", "sid", "n", "rest")).alias("hub"), F.count("*").alias("sets"))
        .where(F.col("sets") > 1)
        .select(
            "gram",
            F.col("hub.sid").alias("hub"),
            F.col("hub.n").alias("hub_n"),
            F.col("hub.rest").alias("hub_rest"),
        ),
        "hubs",
    )
    rows = keep(postings.select("gram", "sid", "n", "rest").join(hubs, "gram"), "postings")
    pair = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    first = keep(
        rows.where(F.col("sid") != F.col("hub"))
        .where(may_link(F.col("n"), F.col("rest"), F.col("hub_n"), F.col("hub_rest"), hundredths))
        .select(F.col("hub").alias("x"), F.col("sid").alias("y"))
        .select(*pair)
        .distinct(),
        "hub-pairs",
    )
    links = keep(verified(first, orders, full, hundredths), "hub-links")
    roots = components(links, keep)
    labelled = (
        rows.join(roots.withColumnRenamed("node", "sid"), "sid", "left")
        .withColumn("root", F.coalesce("root", "sid"))
        .join(roots.toDF("hub", "hub_root"), "hub", "left")
        .withColumn("hub_root", F.coalesce("hub_root", "hub"))
        .withColumn("apart", F.col("root") != F.col("hub_root"))
        .select("gram", "sid", "n", "rest", "root", "apart")
    )
    labelled = keep(labelled, "labelled")
    apart = labelled.where("apart").select(
        "gram", F.col("sid").alias("x"), F.col("n").alias("nx"), F.col("rest").alias("rx"), F.col("root").alias("root_x")
    )
    others = labelled.join(apart.select("gram").distinct(), "gram", "left_semi")
    across = (
        apart.join(others, "gram")
        .where((F.col("root") != F.col("root_x")) & (~F.col("apart") | (F.col("sid") > F.col("x"))))
        .where(may_link(F.col("n"), F.col("rest"), F.col("nx"), F.col("rx"), hundredths))
        .select("x", F.col("sid").alias("y"))
        .select(*pair)
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    return links.union(verified(keep(across, "cross-pairs"), orders, full, hundredths))


def link_components(docs: DataFrame, words: int = WORDS, hundredths: int = HUNDREDTHS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Texts are compared whole, A-Z lowered, as sets of distinct n-grams of ``words`` words; two
    documents link if 100 times their common n-grams are at least ``hundredths`` times all of
    theirs. component_id is the least doc_id reachable by links. Null and empty texts and texts
    without words link with nothing and are their own components. Repeated rows link with each
    other. Null doc_ids take part, too, and get the least doc_id of their component, if it has one.
    Extra columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    work = Scratch(docs.sparkSession)
    result = labelled_rows(docs, words, hundredths, work.keep).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return work.finish(result)[0]


def representatives(docs: DataFrame, words: int = WORDS, hundredths: int = HUNDREDTHS) -> DataFrame:
    """doc_id and text_id (``xxhash64`` of the text) of one row of each component with a doc_id.

    The row with the least doc_id, then the least text_id. Rows with one doc_id may be of several
    components, each of which has its own. Texts without words are components of their own.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_id")
    )
    work = Scratch(docs.sparkSession)
    rows = labelled_rows(docs, words, hundredths, work.keep).where(F.col("doc_id").isNotNull())
    least = (
        rows.where(F.col("n") > 0)
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_id")).alias("row"))
        .select("row.doc_id", "row.text_id")
    )
    alone = rows.where(F.col("n") == 0).select("doc_id", "text_id").distinct()
    return work.finish(least.union(alone))[0]


def labelled_rows(docs: DataFrame, words: int, hundredths: int, keep) -> DataFrame:
    """The rows of ``set_table`` without low, and for texts with words their root and component_id."""
    sets = keep(set_table(docs.withColumn("rep_text", F.xxhash64("text")), words), "sets")
    named = sets.where(F.col("n") > 0)
    # The least doc_id of a set, if one of its documents has any.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rep_text")).alias("first")
    reps = named.groupBy("sid").agg(F.max("n").alias("n"), first)
    reps = keep(
        reps.select("sid", "n", F.col("first.doc_id").alias("rep"), "first.rep_text"), "set-names"
    )
    grams = named.select("sid", F.explode("low").alias("gram"))
    alone = (
        grams.groupBy("gram")
        .agg(F.min("sid").alias("sid"), F.max("sid").alias("last"))
        .where(F.col("sid") == F.col("last"))
        .groupBy("sid")
        .agg(F.count("*").alias("alone"))
    )
    alive = reps.join(alone, "sid", "left").where(
        F.coalesce("alone", F.lit(0)) < prefix_size(F.col("n"), hundredths)
    )
    full = keep(full_sets(docs, keep(alive.select("sid", "rep", "rep_text"), "alive"), words), "full-sets")
    roots = components(set_links(full, hundredths, keep), keep).toDF("sid", "root")
    placed = reps.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = placed.join(least, "root").select("sid", "root", "component_id")
    return sets.drop("low", "rep_text").join(labels, "sid", "left")
