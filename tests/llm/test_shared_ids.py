"""Rows that share a doc_id or have none, and texts with broken-character marks of their own."""

import random

import pytest

import corpus_pipeline
from tickhouse.llm import ngram_join, substrings


def near_copies(n):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("shared", [None, 7])
def test_near_copies_with_one_doc_id(spark, shared):
    texts = near_copies(400)
    own = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = spark.createDataFrame([(shared, t) for t in texts], "doc_id long, text string")
    linked = ngram_join.link_components(one).collect()
    assert len(linked) == 400 and {r["component_id"] for r in linked} == {shared}
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    report = [sorted(tuple(r[n] for n in names) for r in substrings.removal_report(d).collect()) for d in (own, one)]
    assert report[0] == report[1]


def test_own_broken_character_marks_stay(spark):
    passage = "é" + "".join(random.Random(1).choices("abcdefgh ", k=230)) + "è"
    rows = [(1, "mark � one " + passage + " �"), (2, "other " + passage), (3, "x" + passage[:-1] + "ê�")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(docs).collect()}
    # The first byte of the third text's last letter is repeated, so the letter goes as a whole.
    assert left == {1: "mark � one �", 2: "other", 3: "x�"}


def test_one_row_of_a_group_with_any_columns(spark):
    rows = [
        (1, "a b c d e f g h", {"k": 2}, 5), (1, "a b c d e f g h", {"k": 1}, 4), (2, "a b c d e f g h", None, 3),
        (3, "other words are here now", {}, 2), (None, "a b c d e f g h", {"k": 9}, 1), (4, None, None, 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, text_id int")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, (r.tags or {}).get("k"), r.text_id) for r in kept.collect())
    assert got == [(0, 9, 1), (1, 1, 4), (3, None, 2), (4, None, 0)]
