"""Search, conversation repair and sharding against plain versions, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickhouse.llm import dialogue, op12, sharding, treap

MASK = (1 << 64) - 1


# -- sharding ------------------------------------------------------------------------


def plain_jump(key, shards):
    x, stop, after = (key or 0) & MASK, -1, 0
    while after < shards:
        stop = after
        x = (x * 2862933555777941757 + 1) & MASK
        after = int((stop + 1) * (float(1 << 31) / float((x >> 33) + 1)))
    return stop


@pytest.mark.parametrize("shards", [1, 2, 40, 64, 65, 700])
def test_jump_shard(spark, shards):
    rng = random.Random(shards)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(200)] + [*range(50), None, MASK >> 1, -1 << 63]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for r in df.select("k", sharding.jump_shard(F.col("k"), shards).alias("at")).collect():
        assert r["at"]["shard"] == plain_jump(r["k"], shards)
        assert r["at"]["grown"] == plain_jump(r["k"], shards + 1)


def test_shards_need_a_count():
    with pytest.raises(ValueError):
        sharding.jump_shard(F.lit(1), 0)


def test_place_documents(spark):
    rows = [(i % 50, "text %d é" % (i % 7), "x") for i in range(300)]
    rows += [(None, None, "x"), (None, "", "y"), (3, "long " * 400000, "z")] + [(7, "same", "w")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(6)
    got = sharding.place_documents(docs, 5).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode()) + 16
    wanted = Counter((d, size(t), zlib.crc32((t or "").encode()), "key", plain_jump(d, 5), plain_jump(d, 6)) for d, t, _ in rows)
    names = ("doc_id", "size", "text_crc32", "law", "shard", "grown_shard")
    assert Counter(tuple(r[n] for n in names) for r in got) == wanted
    for shard in range(5):
        mine = sorted((r["slot"], r["doc_id"] or -1) for r in got if r["shard"] == shard)
        assert [s for s, _ in mine] == list(range(len(mine)))
        assert [d for _, d in mine] == sorted(d for _, d in mine)
    assert sharding.place_documents(docs.limit(0), 5).count() == 0


def test_one_more_shard(spark, folder):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    moved = {r["doc_id"] for r in sharding.moved_rows(docs, "doc_id", 9).collect()}
    assert 120 < len(moved) < 280
    sharding.write_shards(docs, "doc_id", 9, folder("nine"))
    sharding.add_shard(spark, folder("nine"), folder("ten"), "doc_id", 9)
    before = {r["doc_id"]: r["shard"] for r in spark.read.parquet(folder("nine")).collect()}
    after = {r["doc_id"]: r["shard"] for r in spark.read.parquet(folder("ten")).collect()}
    assert len(before) == len(after) == 2000
    assert {k for k in after if after[k] != before[k]} == moved
    assert all(after[k] == 9 for k in moved)


# -- search --------------------------------------------------------------------------


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_top(docs, items, k):
    terms = [words(t) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    out = Counter()
    for item, text in items:
        scores = []
        for (doc, _), ts in zip(docs, terms):
            tf = Counter(ts)
            m = 10 + 90 * len(ts) * n_docs // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in set(words(text))
                if tf[t]
            )
            if score > 0:
                scores.append((-score, doc is not None, doc or 0))
        for rank, (score, known, doc) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, doc if known else None, -score] += 1
    return out


def test_treap_values():
    rng = np.random.default_rng(1)
    for rows, columns, n in ((40, 9, 120), (3, 70, 100), (1, 1, 1), (500, 2, 300)):
        point = np.sort(rng.choice(rows * columns, n, replace=n > rows * columns))
        point = np.unique(point)
        row, column = point // columns, point % columns
        value = rng.integers(1, 10**6, len(point))
        side = max(rows - 1, columns - 1, 1).bit_length()
        top, cells, drops = treap.build_treap(row, column, value, side)
        assert top == value.max()
        shard = treap.Treap(
            np.arange(columns), np.arange(rows), -np.arange(rows), side, int(columns - 1).bit_length(), top, cells, drops
        )
        for r in range(rows):
            best = treap.Best(columns)
            at, cell, high = shard.enter(np.array([r]))
            # Row 0 is the most frequent term, which here is the last.
            shard.search(at, cell, high, np.array([2]), best)
            mine = row == at[0]
            assert dict(zip(best.doc, best.score)) == dict(zip(column[mine], 2 * value[mine]))


@pytest.mark.parametrize("limit", [200, 1 << 21])
def test_top_documents(spark, monkeypatch, limit):
    monkeypatch.setattr(treap, "SHARD_BYTES", limit)
    monkeypatch.setattr(treap, "BLOCK_TERMS", 20 if limit == 200 else 1 << 16)
    rng = random.Random(limit)
    vocabulary = ["w%d" % i for i in range(60)] + ["Ünï", "ABC", "ünï"]
    some = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(63)], k=n))
    docs = [(i, some(rng.choice([1, 3, 20, 60]))) for i in range(120)]
    docs += [(5, "same w1 w2"), (5, "same w1 w2"), (None, "same w1 w2"), (None, None), (9, ""), (10, "...")]
    items = [(f"q{i}", some(6)) for i in range(12)] + [("q0", "w1"), (None, "same"), ("none", "absent"), ("e", None)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, rank int")
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id string, text string, doc_id int")
    got = Counter(tuple(r) for r in treap.top_documents(df.repartition(3), asked, 4).collect())
    assert got == plain_top(docs, items, 4)
    assert treap.top_documents(df.limit(0), asked).count() == 0
    assert treap.top_documents(df, asked.limit(0)).count() == 0


def test_text_beyond_a_shard(spark):
    long = " ".join("v%d" % (i % 3000) for i in range(600000))
    docs = spark.createDataFrame([(1, long), (2, "v1 v2"), (3, "v1")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "v1 v2999")], "item_id string, text string")
    got = Counter(tuple(r) for r in treap.top_documents(docs, items).collect())
    assert got == plain_top([(1, long), (2, "v1 v2"), (3, "v1")], [("a", "v1 v2999")], 10)


# -- repair --------------------------------------------------------------------------

NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def plain_report(rows):
    """Faults and the least edits of one conversation, by costs with their edits as text."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    rows = sorted(rows, key=order)
    seen, status = set(), []
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            status.append("blank")
        elif (role, text) in seen:
            status.append("duplicate")
        else:
            status.append("fine" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))
    best = {"0": (0, ""), "s": (4, "II"), "u": (2, "I"), "a": (0, "")}
    for (_, role, _), how in reversed(list(zip(rows, status))):
        now = {}
        for q, to in NEXT.items():
            options = [(3 + best[q][0], "D" + best[q][1])]
            if how in ("fine", "truncated"):
                more = how == "truncated"
                options.append((2 + more + best[to][0], "R" + best[to][1]))
                kind = role[:1]
                if kind == to or (kind == "s" and q == "0"):
                    options.append((more + best[kind][0], "K" + best[kind][1]))
            now[q] = min(options)
        for _ in range(2):
            for q, to in NEXT.items():
                now[q] = min(now[q], (2 + now[to][0], "I" + now[to][1]))
        best = now
    cost, audit = best["0"]
    out, left, q = [], iter(rows), "0"
    for edit in audit:
        if edit == "I":
            q = NEXT[q]
            out.append(NAMES[q] + ":")
            continue
        _, role, text = next(left)
        if edit == "R":
            q = NEXT[q]
            out.append(f"{NAMES[q]}:{text}")
        elif edit == "K":
            q = role[:1]
            out.append(f"{role}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [status.count(s) for s in ("blank", "duplicate", "truncated")]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations():
    rng = random.Random(8)
    out = {}
    for c in range(24):
        n = 400 if c < 7 else rng.choice([0, 1, 2, 5, 9, 30])
        roles = [
            ["user"], ["tool", "", "user"], ["system", "user", "assistant"], ["user", "assistant"] * 5 + ["system"],
            ["assistant"], ["system", "tool"], ["user", "assistant", "x"],
        ][c % 7]
        rows = []
        for t in range(n):
            role = rng.choice(roles) if c % 7 != 3 else roles[t % 2] if rng.random() < 0.9 else "system"
            text = rng.choice(["", " \t", "Hi.", "a b c", "ok! ", "no\n", f"{t}?", f"{t}", f"{t}.", f"{t}. "])
            rows.append((rng.choice([t, t, None]) if c % 7 == 6 else t, role, text))
        out[c or None] = rows
    return out


@pytest.mark.parametrize("bits", [5, 12])
def test_repair(spark, bits):
    talks = conversations()
    rows = [(c, *r, "x") for c, rs in talks.items() for r in rs]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at string")
    known = spark.createDataFrame([(c,) for c in talks], "conv_id long")
    got = dialogue.audit_report(df.repartition(5), known, bits)
    got = {r["conv_id"]: tuple(r[n] for n in REPORT) for r in got.collect()}
    assert got == {c: plain_report(rs) for c, rs in talks.items()}


def test_few_passes(spark):
    rows = [(1, t, "user", f"{t}.") for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repair = dialogue.Repair(df.coalesce(1), 4)
    assert repair.chunks.count() >= 44
    assert repair.passes <= 4
    assert repair.chunks.agg(F.sum("cost")).first()[0] == 700


def test_repaired_rows(spark):
    rows = [("c", 0, "system", "Be kind."), ("c", 1, "assistant", "Hello."), ("c", 2, "tool", "Go!"), ("c", 3, None, None)]
    rows += [("d", 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = dialogue.Repair(df).rows().orderBy("at", "n").select("edit", "turn", "role", "text").collect()
    assert [tuple(r) for r in got] == [
        ("K", 0, "system", "Be kind."), ("R", 1, "user", "Hello."), ("R", 2, "assistant", "Go!"),
        ("K", 0, "user", "Hi."), ("I", None, "assistant", ""),
    ]
    assert dialogue.Repair(df.limit(0)).rows().count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"a.{t}!") for c in range(20) for t in [*range(10), None]] + [(None, 1, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    wanted = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role or " "
        wanted[c, t, role, text] += {0: 0, 3: 2}.get(kind, 1)
    got = Counter(tuple(r) for r in op12.damaged(df).collect())
    assert got == +wanted
