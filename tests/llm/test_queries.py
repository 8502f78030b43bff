"""The registered queries against SQL or brute force over whole tables, and the pipeline."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_numbers import brute_counts, brute_matches, brute_repeats
from test_operators import brute_components
from tickhouse.llm import op02
from tickhouse.llm.queries import ORACLE, QUERIES
from tools import check_oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return check_oracle.connect(SF)


@pytest.fixture(scope="module")
def texts(oracle):
    return dict(oracle.execute("select doc_id, text from documents order by doc_id").fetchall())


def rows(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF).collect()}


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, oracle, name):
    good, message = check_oracle.compare(spark, oracle, SF, name)
    assert good, message


def test_op2(spark, oracle, texts):
    got = rows(spark, "op2_subword_toxicity")
    assert set(got) == set(texts)
    labels = dict(oracle.execute("select doc_id, toxic from labels").fetchall())
    for k, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= op02.CUTOFF)
    held = [k for k in labels if got[k]["held_out"]]
    assert np.mean([got[k]["predicted"] == labels[k] for k in held]) > 0.8


def test_op3_brute_force(spark, texts):
    got = rows(spark, "op3_multi_order_join")
    wanted = brute_components(list(texts.values()))
    ids = list(texts)
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in got.items()} == {
        ids[i]: (n, ids[c]) for i, n, c in wanted
    }


def test_op4_adds_up(spark, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sums: dict[int, int] = {}
    for r in QUERIES["op4_offset_attribution"](spark, SF).collect():
        sums[r["doc_id"]] = sums.get(r["doc_id"], 0) + r["n_tokens"]
        assert "\n" not in texts[r["doc_id"]][r["start"] : r["end"] - 1]
    for k, text in texts.items():
        assert sums.get(k, 0) == len(plain.encode(text, add_special_tokens=False).ids)


def test_op6(spark, oracle, texts):
    items = [(str(k), t) for k, t in oracle.execute("select item_id, text from benchmark").fetchall()]
    got = rows(spark, "op6_suffix_decontamination")
    short = [k for k, t in texts.items() if len(t) < 2500]
    assert len(got) == len(texts) and len(short) > 100
    hits = 0
    for k in short:
        n, hit, found, _ = brute_matches(texts[k], items, 13)
        r = got[k]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(found))
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
        hits += hit > 0
    assert hits


def test_op7(spark, texts):
    got = rows(spark, "op7_prefix_doubling_dedup")
    wanted = brute_repeats(list(texts.values()), 200)
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert {k: tuple(r[c] for c in columns) for k, r in got.items()} == {
        k: w[:4] for k, w in zip(texts, wanted)
    }


def test_op8(spark, texts):
    got = rows(spark, "op8_adaptive_quality")
    for k, text in texts.items():
        r, counts = got[k], brute_counts(text)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert [r[c] for c in names] == counts[:5]
        base = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r["base_failed"] == base and not (base and r["kept"])
    assert sum(r["kept"] for r in got.values()) > len(texts) / 2


def ids_of(file, text, end):
    path = public_tokenizers.path(file)
    return [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op9(spark, texts):
    got = QUERIES["op9_configuration_packing"](spark, SF).toPandas()
    wanted = set()
    for k, text in texts.items():
        ids = ids_of("byte_bpe_50k.json", text, 2)
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
        wanted |= {(k, i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert set(map(tuple, got[columns].to_numpy().tolist())) == wanted and len(got) == len(wanted)
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        assert sequence["offset"].tolist() == [0, *np.cumsum(sequence["length"])[:-1]]
        assert sequence["length"].sum() <= 1024
    assert got["sequence_id"].nunique() <= 1.02 * got["length"].sum() / 1024 + 2


def test_op10(spark, texts):
    got, start = rows(spark, "op10_repair_files"), 0
    for k, text in texts.items():
        ids = ids_of("word_bpe_49k.json", text, 1)
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_pipeline_keeps_unlinked_texts_of_one_doc_id(spark):
    one, two, three = (" ".join(f"{w}{k}" for k in range(60)) for w in ("red", "green", "blue"))
    rows = [
        (5, one), (5, two), (7, one), (7, two), (5, one), (8, three), (8, three + " end"),
        (9, ""), (9, None), (9, two), (None, one),
    ]
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(*r, "en") for r in rows], schema).repartition(3)
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    last = [r for r in got if r[0] == 8]
    assert len(last) == 1 and last[0][1] in (three, three + " end")
    wanted = [(5, one), (5, two), (9, ""), (9, None), (None, one), *last]
    assert got == sorted(wanted, key=repr)


def test_pipeline_against_brute_force(spark, oracle, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = dict(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(got)
        if name == "ngram_jaccard_join":
            ids = list(kept)
            first = {ids[c] for _, _, c in brute_components(list(kept.values()))}
            assert got == {k: t for k, t in kept.items() if k in first}
        elif name == "suffix_array_dedup":
            left = brute_repeats(list(kept.values()), 200)
            wanted = {k: w[4].decode("utf-8", "ignore") for k, w in zip(kept, left)}
            assert got == {k: t for k, t in wanted.items() if t or not kept[k]}
        elif name == "benchmark_decontamination":
            dirty = rows(spark, "op6_suffix_decontamination")
            same = [k for k in kept if kept[k] == texts[k]]
            assert all((k in got) != dirty[k]["contaminated"] for k in same)
        else:
            assert set(got) <= set(kept) and len(got) > 0.7 * len(kept)
        kept = got
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed["doc_id"]) == set(kept)
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024
    total = sum(len(ids_of("byte_bpe_50k.json", t, 2)) for t in kept.values())
    assert packed["length"].sum() == total
