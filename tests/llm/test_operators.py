"""Every operator on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_numbers import brute_counts, brute_matches, brute_repeats, brute_sets
from tickhouse.llm import (
    attribution, chat, decontaminate, grammar, ngram_join, op02, op05, packing, quality,
    substrings, toxicity, urls,
)
from tickhouse.llm.arrays import column_bytes
from tickhouse.llm.components import components

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Chat formatting


def said(spark, rows):
    return frame(spark, rows, "conv_id long, turn long, role string, text string")


def test_examples_hold_all_turns_before_their_reply(spark):
    turns = said(
        spark,
        [(1, 2, "user", "more"), (1, 0, "user", "hi"), (1, 1, "assistant", "a<|im_end|>&lt;"), (1, 3, "assistant", "[b]\n")],
    )
    rows = chat.prefix_examples(turns).orderBy(F.col("example").asc_nulls_last()).collect()
    assert [r["example"] for r in rows] == [1, 2, None]
    texts = [r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_chars"]] for r in rows[:2]]
    assert texts == ["a&lt;|im_end|>&amp;lt;", "&#91;b]\n"]
    assert rows[1]["formatted"].startswith(rows[0]["formatted"])
    assert rows[2]["formatted"] == rows[1]["formatted"] and rows[2]["loss_chars"] == 0
    back = chat.prefix_examples(turns).where("example is null").select(chat.parse_turns(F.col("formatted")))
    assert [tuple(t) for t in back.first()[0]] == [
        ("user", "hi"), ("assistant", "a<|im_end|>&lt;"), ("user", "more"), ("assistant", "[b]\n"),
    ]


def test_chat_edges(spark):
    rows = [
        (None, 0, "user", "no id"), (2, None, None, None), (2, None, "x\ny", ""), (3, 0, "assistant", None),
        (3, 0, "assistant", None), (4, 0, "user", "é" * 5000),
    ]
    turns = said(spark, rows).withColumn("formatted", F.lit(1))
    got = {
        (r["conv_id"], r["example"]): r
        for r in chat.prefix_examples(turns).withColumn("turns", chat.parse_turns(F.col("formatted"))).collect()
    }
    assert [tuple(t) for t in got[None, None]["turns"]] == [("user", "no id")]
    assert [tuple(t) for t in got[2, None]["turns"]] == [("", ""), ("x\ny", "")]
    assert [(k, got[3, k]["loss_chars"]) for k in (1, 2, None)] == [(1, 0), (2, 0), (None, 0)]
    assert got[4, None]["turns"][0]["text"] == "é" * 5000
    assert chat.prefix_examples(said(spark, [])).count() == 0


def test_chat_stays_in_the_jvm(spark):
    plan = plan_text(chat.prefix_examples(said(spark, [(1, 0, "user", "x")])))
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


# Toxicity

CLEAN = "the river runs past the old mill and under the stone bridge near town".split()
TOXIC = ["idiot", "moron", "loser"]


def labelled(n=600, seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        words = [pick.choice(CLEAN) + pick.choice(["", "s", "ing"]) for _ in range(pick.randrange(5, 90))]
        toxic = int(i % 4 == 0)
        for _ in range(toxic * 2):
            words.insert(pick.randrange(len(words)), pick.choice(TOXIC))
        rows.append((i, " ".join(words), toxic))
    return rows


def trained(rows):
    data, starts = column_bytes(pa.array([t for _, t, _ in rows]))
    return toxicity.train([(data, starts, [y for _, _, y in rows])])


def scores(model, texts):
    data, starts = column_bytes(pa.array(texts))
    return model.scores(data, starts)


def test_held_out_accuracy_and_misspellings():
    model = toxicity.Model.from_bytes(trained(labelled()).to_bytes())
    other = labelled(300, 9)
    found = scores(model, [t for _, t, _ in other]) >= 0.3
    wanted = np.array([y for _, _, y in other]) == 1
    assert (found == wanted).mean() > 0.97
    clean = "the river runs past the old mill"
    plain, misspelt = scores(model, [clean, clean + " idiott morron"])
    assert misspelt > 10 * plain
    # A long text is as toxic as its worst stretch.
    assert scores(model, [" ".join(CLEAN * 400 + TOXIC)])[0] >= 0.3


def test_toxicity_edges(spark):
    docs = frame(spark, [(i, t) for i, t, _ in labelled(200)] + [(None, None), (900, ""), (900, "")])
    docs = docs.withColumn("score", F.lit("old")).withColumn("words", F.lit(1))
    labels = frame(spark, [(i, y) for i, _, y in labelled(200)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    scored = toxicity.with_scores(docs, toxicity.fit(docs, labels))
    rows = scored.collect()
    assert len(rows) == 203 and scored.columns == ["doc_id", "text", "words", "score"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    nothing = toxicity.fit(docs, labels.where("doc_id < 0"))
    assert {r["score"] for r in toxicity.with_scores(docs, nothing).collect()} == {0.0}
    one_class = toxicity.fit(docs, labels.where("toxic = 1"))
    assert {r["score"] for r in toxicity.with_scores(docs, one_class).collect()} == {1.0}
    assert toxicity.with_scores(docs.limit(0), one_class).count() == 0


# Joins


def brute_components(texts, words=4, hundredths=85):
    sets = [brute_sets(t or "", words) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= hundredths * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(sets[i]), find(i)) for i in range(len(sets))]


def edited(pick, words, edits):
    words = list(words)
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"w{pick.randrange(10**6)}"
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_join_finds_the_components_of_all_links(spark, seed):
    pick = random.Random(seed)
    base = [f"b{k}" for k in range(130)]
    texts = [" ".join(edited(pick, base, pick.randrange(0, 6))) for _ in range(60)]
    # A chain in which only neighbours link, passages in unlike texts, and texts of few words.
    chain = [f"c{k}" for k in range(100)]
    for k in range(8):
        texts.append(" ".join(chain))
        chain = edited(pick, chain, 1)
    texts += [" ".join([f"u{i}_{k}" for k in range(40)] + base[:60]) for i in range(10)]
    texts += ["", None, " \n", "one", "One", "one two", "one two three four", "ONE two three four"]
    texts += [" ".join(pick.choice("abcd") for _ in range(pick.randrange(3, 12))) for _ in range(40)]
    pick.shuffle(texts)
    got = ngram_join.link_components(frame(spark, list(enumerate(texts))).withColumn("sid", F.lit(0)))
    assert sorted(map(tuple, got.collect())) == brute_components(texts)


def test_join_edges(spark):
    text = "one two three four five six"
    rows = [(5, text), (3, text.upper()), (3, text.upper()), (None, text), (None, "alone in here all day"), (7, None)]
    got = sorted(map(tuple, ngram_join.link_components(frame(spark, rows)).collect()), key=repr)
    wanted = [(3, 3, 3), (3, 3, 3), (5, 3, 3), (7, 0, 7), (None, 2, None), (None, 3, 3)]
    assert got == sorted(wanted, key=repr)
    assert ngram_join.link_components(frame(spark, [])).count() == 0


def test_components(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 99), (99, 98), (98, 100), (7, 7), (200, 201), (200, 201)]
    got = dict(map(tuple, components(frame(spark, path, "a long, b long")).collect()))
    wanted = {**{k: 0 for k in range(41)}, 98: 98, 99: 98, 100: 98, 200: 200, 201: 200}
    assert got == wanted
    assert components(frame(spark, [], "a long, b long")).count() == 0


# Token attribution


@pytest.mark.parametrize("rule", attribution.RULES)
def test_tokens_of_lines(spark, rule):
    pick = random.Random(2)
    alphabet = ["a", "bc ", "\n", "é", "\n\n", " ", "   x", "世"]
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randrange(30))) for _ in range(150)]
    texts += [None, "", "\n", "x" * 3000 + "\n" + "y " * 3000]
    docs = attribution.with_line_sections(frame(spark, list(enumerate(texts))))
    got = collections.defaultdict(dict)
    for r in attribution.attribute_tokens(docs, BYTES, rule).collect():
        got[r["doc_id"]][r["section"]] = (r["start"], r["end"], r["n_tokens"], r["n_crossing"])
    plain = Tokenizer.from_file(BYTES)
    for i, text in enumerate(texts):
        lines, at = [], 0
        for line in (text or "").split("\n"):
            lines.append([at, at + len(line) + 1, 0, 0])
            at += len(line) + 1
        lines[-1][1] -= 1
        lines = [x for x in lines if x[1] > x[0]]
        for a, b in plain.encode(text or "", add_special_tokens=False).offsets:
            shares = [(min(b, x[1]) - max(a, x[0]), k) for k, x in enumerate(lines)]
            touched = [(n, k) for n, k in shares if n > 0]
            most = min(touched, key=lambda t: (-t[0], t[1]))[1]
            k = {"most": most, "first": touched[0][1], "last": touched[-1][1]}[rule]
            lines[k][2] += 1
            lines[k][3] += len(touched) > 1
        assert got[i] == {k: tuple(x) for k, x in enumerate(lines)}


def test_attribution_edges(spark):
    sections = "sections array<struct<kind:string,start:long,end:long>>"
    rows = [
        (1, "hello big world", [("b", 3, 9), None, ("a", 0, 5), ("c", 40, 50)]),
        (1, "hello big world", None),
        (None, None, [("a", 0, 5)]),
    ]
    docs = frame(spark, rows, f"doc_id long, text string, {sections}").withColumn("kind", F.lit(0))
    got = sorted(map(tuple, attribution.attribute_tokens(docs, BYTES).collect()), key=repr)
    assert got == sorted(
        [
            (1, 0, "a", 0, 5, 1, 0), (1, 1, "b", 3, 9, 1, 0), (1, 2, "c", 40, 50, 0, 0),
            (1, None, None, None, None, 1, 0), (1, None, None, None, None, 3, 0), (None, 0, "a", 0, 5, 0, 0),
        ],
        key=repr,
    )
    assert attribution.attribute_tokens(docs.limit(0), BYTES).count() == 0
    with pytest.raises(ValueError):
        attribution.attribute_tokens(docs, BYTES, "half")


# Urls


def test_urls(spark):
    wanted = {
        "https://WWW.Example.com/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "http://example.com/EN/": ("example.com", "/EN/", "com/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://a.net/es/porn": ("a.net", "/es/porn", "net/es/", "block"),
        "http://a.org/porn": ("a.org", "/porn", None, "block"),
        "http://a.org/pornographer": ("a.org", "/pornographer", None, "allow"),
        "http://a.org/poker-poker": ("a.org", "/poker-poker", None, "allow"),
        "http://poker.org/BETTING/x": ("poker.org", "/BETTING/x", None, "block"),
        "http://a.org/épornü": ("a.org", "/épornü", None, "allow"),
        "a.net/es/": ("", "", None, "allow"),
        "x://y://z/w": ("y:", "//z/w", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = frame(spark, [(u, 1) for u in wanted] * 2, "url string, verdict int")
    rows = urls.judge_urls(pages, op05.RULES).select("url", "host", "path", "rule", "verdict").collect()
    assert len(rows) == 2 * len(wanted)
    assert {r[0]: tuple(r)[1:] for r in rows} == wanted
    assert urls.judge_urls(pages.limit(0), op05.RULES).count() == 0


# Benchmark


def test_decontamination(spark):
    pick = random.Random(3)
    words = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(pick.choice(words) for _ in range(n))) for k, n in ((1, 20), (10, 5), (2, 13), (3, 0))]
    docs = [(k, " ".join(pick.choice(words) for _ in range(40))) for k in range(5)]
    docs += [(k, f"x {items[k % 3][1].upper()}, y" + " z" * (300 * (k % 2))) for k in range(5, 12)]
    docs += [(None, items[0][1]), (20, None), (20, None), (21, "")]
    df = frame(spark, [(*d, 4) for d in docs], f"{DOCS}, items int")
    benchmark = frame(spark, [*items, (None, "q r s"), (9, None)], "item_id long, text string")
    found = decontaminate.find_matches(df, benchmark)
    got = [(r["text"], r["n_words"], r["n_hit"], r["items"], r["longest"]) for r in found.collect()]
    texts = [(str(k), t) for k, t in items]
    assert [g[1:] for g in got] == [brute_matches(t or "", texts, 13) for _, t in docs]
    kept = decontaminate.remove_contaminated(df, benchmark)
    assert kept.columns == df.columns
    dirty = [20 * h >= n and h > 0 for _, n, h, _, _ in got]
    assert kept.count() == len(docs) - sum(dirty) and sum(dirty) >= 5
    assert decontaminate.find_matches(df, benchmark.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.find_matches(df.limit(0), benchmark).count() == 0


# Repeated substrings


@pytest.mark.parametrize("seed,threshold,core", [(1, 200, 48), (2, 200, 64), (3, 60, 20)])
def test_repeats(spark, seed, threshold, core):
    pick = random.Random(seed)
    base = "".join(pick.choice("abcdeé ") for _ in range(3000))
    texts = [None, "", "x" * (threshold - 1), "x" * threshold]
    for _ in range(36):
        kind = pick.random()
        if kind < 0.2:
            text = "".join(pick.choice("abcde é") for _ in range(pick.randrange(900)))
        elif kind < 0.6:
            text = ""
            for _ in range(pick.randrange(1, 5)):
                at = pick.randrange(2800)
                text += base[at : at + pick.randrange(5, 500)] + "z" * pick.randrange(50)
        elif kind < 0.7:
            text = pick.choice(["ab", "a", "abc"]) * pick.randrange(10, 400)
        elif kind < 0.9:
            text = list(pick.choice([t for t in texts if t]))
            for _ in range(3):
                text[pick.randrange(len(text))] = pick.choice("QRS")
            text = "".join(text)
        else:
            text = pick.choice([t for t in texts if t])
        texts.append(text)
    wanted = brute_repeats(texts, threshold)
    docs = frame(spark, [(None if i == 7 else i, t, i) for i, t in enumerate(texts)], f"{DOCS}, spans int")
    rows = substrings.removal_report(docs, threshold, core).collect()
    got = {7 if r["doc_id"] is None else r["doc_id"]: tuple(r)[1:] for r in rows}
    assert [got[i] for i in range(len(texts))] == [w[:4] for w in wanted]
    kept = {r["spans"]: r["text"] for r in substrings.remove_repeats(docs, threshold, core).collect()}
    for i, (text, row) in enumerate(zip(texts, wanted)):
        left = row[4].decode("utf-8", "ignore")
        assert kept.get(i, "") == (left if row[1] else text or "" if text is not None else None)


def test_repeats_edges(spark):
    pick = random.Random(4)
    text = "".join(pick.choice("abcdefgh ") for _ in range(5000))
    docs = frame(spark, [(1, text), (1, text), (1, text[:100] + "!" + text[2000:]), (2, "short")])
    rows = sorted(substrings.removal_report(docs).select("n_bytes", "n_removed", "n_spans").collect())
    assert [tuple(r) for r in rows] == [(5, 0, 0), (3101, 3000, 1), (5000, 5000, 1), (5000, 5000, 1)]
    assert substrings.removal_report(docs.limit(0)).count() == 0
    kept = substrings.remove_repeats(docs.withColumn("n_chars", F.length("text").cast("int")))
    assert {(r["text"], r["n_chars"]) for r in kept.collect()} == {("short", 5), (text[:100] + "!", 101)}
    assert substrings.remove_repeats(docs.limit(0)).columns == docs.columns


# Toxicity


def test_toxic_documents_are_found(spark):
    assert toxicity.TRAIN_DOCS >= 10_000 and toxicity.TRAIN_BYTES >= 48 << 20
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(op02.held_out())
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    scored = op02.run(spark, sf).where("predicted = 1").select("doc_id").collect()
    staged = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, sf).select("doc_id").collect()}
    for marked in ({r["doc_id"] for r in scored}, {k for k in toxic if k not in staged}):
        found = [toxic[k] for k in marked if k in toxic]
        assert sum(found) > 0.7 * sum(toxic.values()) and sum(found) > 0.8 * len(found)


# Quality


def test_quality(spark):
    pick = random.Random(5)
    words = [f"word{k}" for k in range(400)]
    rows = []
    for k in range(400):
        text = " ".join(pick.choice(words) for _ in range(pick.randrange(60, 90)))
        rows.append((k, text, ["en", "de"][k % 2], None if k % 3 else "s"))
    odd = " ".join(f"{pick.choice(words)}#$%" for _ in range(80))
    rows += [(400, odd, "en", "s"), (401, None, None, None), (402, "", "en", "s"), (403, "few words", "en", None)]
    rows += [(404, " ".join(["a b c"] * 40), "en", "s"), (405, rows[0][1], "xx", "new"), (405, rows[0][1], "xx", "new")]
    docs = frame(spark, rows, f"{DOCS}, lang string, source string").withColumn("kept", F.lit("old"))
    got = quality.judge(docs, min_group=20).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text, _, _ in rows:
        counts = brute_counts(text or "")
        assert [by_id[doc_id][c] for c in quality.COUNTS] == counts
        assert by_id[doc_id]["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
    assert all(by_id[k]["kept"] for k in [*range(400), 405])
    assert by_id[400]["failed"] == ["symbol_ratio", "word_length"] and not by_id[400]["kept"]
    assert not any(by_id[k]["kept"] for k in (401, 402, 403, 404))
    assert quality.judge(docs.limit(0)).count() == 0


def test_sketches_merge_and_keep_their_error(spark):
    values = np.random.default_rng(1).lognormal(0, 1, 4000)
    columns = {r: F.col("v") for r in quality.RULES}
    rows = frame(spark, [(["a", "b"][k % 2], float(v)) for k, v in enumerate(values)], "lang string, v double")
    rows = rows.select("lang", F.lit("s").alias("source"), *[c.alias(r) for r, c in columns.items()])
    fine = quality.sketches(rows, ["lang", "source"])
    merged = sorted(map(tuple, quality.merge(fine, []).collect()))
    assert merged == sorted(map(tuple, quality.sketches(rows, []).collect()))
    fence = quality.fences(quality.merge(fine, []), [], 1).where("rule = 'word_length'").first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    reach = quality.REACH * max(q3 - q1, quality.RULES["word_length"])
    assert abs(fence["high"] - (q3 + reach)) < 0.05 * (q3 + reach)


def test_fences_follow_each_group(spark):
    rng = np.random.default_rng(2)
    groups = {"a": (0.02, 5.0, 0.1), "b": (0.2, 7.0, 0.3)}
    rows, wanted = [], {}
    for source, (scale, middle, spread) in groups.items():
        ratio = np.where(rng.random(600) < 0.9, 0.0, rng.uniform(0, scale, 600))
        length = rng.normal(middle, spread, 600)
        rows += [("en", source, *[float(x)] * 3, float(y)) for x, y in zip(ratio, length)]
        q1, q3 = np.quantile(length, [0.25, 0.75])
        tail = np.quantile(ratio, quality.TAIL)
        wanted[source] = (tail, q3 + quality.REACH * (q3 - q1), q1 - quality.REACH * (q3 - q1))
    names = ", ".join(f"{r} double" for r in quality.RULES)
    got = {
        r["source"]: r
        for r in quality.thresholds(frame(spark, rows, f"lang string, source string, {names}"), 0).collect()
    }
    for source, (tail, high, low) in wanted.items():
        for rule in ("symbol_ratio", "dup_line_ratio", "repeat_ratio"):
            fence = got[source][f"fence_{rule}"]
            assert fence["low"] is None and abs(fence["high"] - tail) < 0.1 * tail
        fence = got[source]["fence_word_length"]
        assert abs(fence["high"] - high) < 0.03 * high and abs(fence["low"] - low) < 0.03 * low
    assert all(got["a"][f"fence_{r}"]["high"] < got["b"][f"fence_{r}"]["high"] for r in quality.RULES)


def test_fences_do_not_switch_with_the_group_size(spark):
    names = ", ".join(f"{r} double" for r in quality.RULES)
    highs = []
    for n in (1, 99, 101, 9900):
        rows = [("en", "big", 0.0, 0.0, 0.0, 5.0)] * (100 * n) + [("en", "s", 0.2, 0.2, 0.2, 5.0)] * n
        got = quality.thresholds(frame(spark, rows[-2100:], f"lang string, source string, {names}"))
        highs.append(got.where("source = 's'").first()["fence_symbol_ratio"]["high"])
    assert highs[0] < 0.01 and abs(highs[1] - 0.1) < 0.005 and 0 <= highs[2] - highs[1] < 0.005
    assert abs(highs[3] - 0.2) < 0.002


def test_every_quality_rule_fires(spark):
    pick = random.Random(6)
    words = [f"word{k}" for k in range(400)]

    def line(n):
        return " ".join(pick.choice(words) for _ in range(n))

    rows = [(k, "\n".join(line(8) for _ in range(12)), "en", "s") for k in range(200)]
    lines = [pick.choice(words) for _ in range(4)] + [line(8) for _ in range(12)]
    odd = {
        "symbol_ratio": f"{line(96)} ### $$$",
        "dup_line_ratio": "\n".join([*lines, *lines[:4]]),
        "repeat_ratio": line(80) + " " + " ".join(["again and more"] * 4),
        "word_length": " ".join(f"{w}s" * 2 for w in line(80).split()),
    }
    rows += [(1000 + k, text, "en", "s") for k, text in enumerate(odd.values())]
    got = quality.judge(frame(spark, rows, f"{DOCS}, lang string, source string")).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert not any(r["base_failed"] for r in got)
    for k, rule in enumerate(odd):
        assert rule in by_id[1000 + k]["failed"] and not by_id[1000 + k]["kept"]
    assert all(by_id[k]["kept"] for k in range(200))


# Packing and files


def encoded(path, text, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


MIXED = [(1, "hello world " * 40), (2, None), (3, ""), (None, "a b c"), (1, "hello world " * 40), (5, "x y, z! " * 900)]


def test_packing(spark):
    rows = frame(spark, [(*r, 0) for r in MIXED], f"{DOCS}, part int")
    got = packing.pack(rows, BYTES, 2, 64).toPandas()
    wanted = []
    for doc_id, text in MIXED:
        ids = encoded(BYTES, text, 2)
        head = len(ids) % 64 or 64
        cuts = [0, *range(head, len(ids), 64), len(ids)]
        wanted += [(doc_id, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    found = [
        (None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
        for r in got.itertuples()
    ]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        assert sequence["offset"].tolist() == [0, *np.cumsum(sequence["length"])[:-1]]
        assert sequence["length"].sum() <= 64
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 64) + 1
    assert packing.pack(rows.limit(0), BYTES, 2).count() == 0


def test_packing_of_one_length(spark):
    """Nearly all pieces are full: no window and no sort, and each has a sequence of its own."""
    text = "word " * 400
    rows = frame(spark, [(i, text) for i in range(300)] + [(1000, "end")], DOCS).repartition(7)
    got = packing.pack(rows, BYTES, 2, 8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    places = got.select("length", "sequence_id", "offset").toPandas()
    full = places[places["length"] == 8]
    assert len(full) > 0.9 * len(places) and full["sequence_id"].is_unique
    assert not places.duplicated(["sequence_id", "offset"]).any()


def test_ranks_within_a_length():
    seen = np.zeros(5, np.int64)
    assert packing.rank_within(np.array([4, 1, 4, 4, 1]), seen).tolist() == [0, 0, 1, 2, 1]
    assert packing.rank_within(np.array([1, 4, 3]), seen).tolist() == [2, 3, 0]
    assert packing.rank_within(np.array([], np.int64), seen).tolist() == []
    assert seen.tolist() == [0, 3, 0, 1, 4]


def test_files(spark, folder):
    rows = [*MIXED, *[(k, f"text number {k} " * (k % 17)) for k in range(10, 200)]]
    docs = frame(spark, rows).repartition(3).withColumn("n_ids", F.lit("x"))
    grammar.write_files(docs, WORDS, 1, folder("files"), shard_ids=100)
    got = [tuple(r) for r in grammar.read_files(spark, folder("files")).orderBy("start").collect()]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    wanted, start = [], 0
    for doc_id, text in ordered:
        ids = encoded(WORDS, text, 1)
        wanted.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == wanted
    assert spark.read.parquet(folder("files")).count() > 5
    grammar.write_files(docs.limit(0), WORDS, 1, folder("none"))
    assert grammar.read_files(spark, folder("none")).count() == 0


def test_digest_of_empty_is_fixed():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
