"""Numpy parts against plain Python on random small inputs."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickhouse.llm import arrays, decontaminate, grammar, ngram_join, packing, quality, substrings, tokens


def texts_of(seed, alphabet, n=400, longest=60):
    pick = random.Random(seed)
    return ["".join(pick.choice(alphabet) for _ in range(pick.randrange(longest))) for _ in range(n)]


def block(texts):
    return arrays.column_bytes(pa.array(texts, pa.string()))


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("alnum,pattern", [(False, r"[^\x20\x09-\x0D]+"), (True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words(alnum, pattern):
    texts = texts_of(1, ["a", "B", "é", "7", "-", " ", "\n", "\x0b", "世"]) + ["", " ", "a"]
    data, starts = block(texts)
    data = arrays.lower(data)
    first, end, per_text = arrays.word_spans(data, starts, alnum)
    found = [data[a:b].tobytes().decode() for a, b in zip(first, end)]
    wanted = [re.findall(pattern, lowered(t)) for t in texts]
    assert per_text.tolist() == [len(w) for w in wanted]
    assert found == [w for ws in wanted for w in ws]


def test_column_bytes_of_nulls_slices_and_nothing():
    column = pa.array(["ab", None, "", "é"])
    data, starts = arrays.column_bytes(column.slice(1))
    assert data.tobytes() == "é".encode() and starts.tolist() == [0, 0, 0, 2]
    data, starts = arrays.column_bytes(pa.array([], pa.string()))
    assert len(data) == 0 and starts.tolist() == [0]


def test_blocks_take_long_rows_alone():
    starts = np.array([0, 3, 4, 100, 101])
    assert list(arrays.blocks(starts, 10)) == [(0, 2), (2, 3), (3, 4)]


def test_window_names_do_not_depend_on_the_place():
    data, _ = block(["xxabcdyyabcd"])
    rolling = arrays.Rolling(data)
    assert rolling.between(np.array([2]), np.array([6])) == rolling.between(np.array([8]), np.array([12]))
    assert rolling.windows(4)[2] == rolling.windows(4)[8] != rolling.windows(4)[3]
    assert len(rolling.windows(13)) == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_encoding_is_encoding_whole_texts(name):
    alphabet = [*"ab Z'é  ́\n\t 1,.!<|Σς\x85 　ß世\r\x1c", "<|endoftext|>", "'s", "'re", "<|startoftext|>", "  "]
    texts = texts_of(2, alphabet, 3000, 40)
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    data, starts = block(texts)
    ids, counts, begin, end = tokens.ChunkEncoder(path, spans=True).encode(data, starts)
    fast, _ = tokens.ChunkEncoder(path).encode(data, starts)
    assert (ids == fast).all()
    edges = np.cumsum([0, *counts])
    for text, a, b in zip(texts, edges, edges[1:]):
        whole = plain.encode(text, add_special_tokens=False)
        assert whole.ids == ids[a:b].tolist(), repr(text)
        assert whole.offsets == list(zip(begin[a:b].tolist(), end[a:b].tolist()))


def test_forgotten_chunks_are_learned_again():
    encoder = tokens.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    before = encoder.encode(*block(["one two three"]))[0].tolist()
    encoder.forget()
    assert encoder.encode(*block(["one two three"]))[0].tolist() == before


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return [len(words), sum(map(len, words)), symbols, again, len(hit), lines]


def test_quality_counts():
    texts = texts_of(3, "ab é\n #", 1500) + ["", "\n", "a\na\n\n a", "x x x x"]
    assert quality.count_block(*block(texts)).tolist() == [brute_counts(t) for t in texts]


def brute_sets(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def test_ngram_sets():
    texts = texts_of(4, ["a", "A", "b ", " ", "\n"], 800, 30) + ["", " ", "a b", "A b"]
    name, counts, whole = ngram_join.ngram_sets(*block(texts))
    sets = [frozenset(brute_sets(t, 4)) for t in texts]
    assert counts.tolist() == [len(s) for s in sets]
    by_name = collections.defaultdict(set)
    for n, s in zip(whole.tolist(), sets):
        by_name[n].add(s)
    assert all(len(s) == 1 for s in by_name.values()) and len(by_name) == len(set(sets))
    edges = np.cumsum([0, *counts])
    for i in range(0, 300, 7):
        for j in range(i, 300, 11):
            both = set(name[edges[i] : edges[i + 1]].tolist()) & set(name[edges[j] : edges[j + 1]].tolist())
            assert len(both) == len(sets[i] & sets[j])


def brute_matches(text, items, window):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    hit, found, longest = set(), set(), 0
    for name, item in items:
        other = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(item))
        if not other:
            continue
        size = min(window, len(other))
        windows = {tuple(other[k : k + size]) for k in range(len(other) - size + 1)}
        for p in range(len(words) - size + 1):
            if tuple(words[p : p + size]) in windows:
                hit |= set(range(p, p + size))
                found.add(name)
        for p in range(len(words)):
            for k in range(len(other)):
                n = 0
                while p + n < len(words) and k + n < len(other) and words[p + n] == other[k + n]:
                    n += 1
                longest = max(longest, n if n >= size else 0)
    return len(words), len(hit), sorted(found), longest


@pytest.mark.parametrize("seed", range(8))
def test_benchmark_matches(seed):
    pick = random.Random(seed)
    vocabulary = ["a", "B", "é", "c9", "d"][: pick.randrange(2, 6)]

    def made(longest):
        words = (pick.choice(vocabulary) + pick.choice([" ", "-", ".\n"]) for _ in range(pick.randrange(longest)))
        return "".join(words)

    docs = [made(40) for _ in range(20)] + [""]
    items = [(str(i), made(9)) for i in range(6)]
    halves = [items[:3], items[3:]]
    queries = [
        decontaminate.Queries(pa.array([t for _, t in half]), np.arange(3) + 3 * k, 4)
        for k, half in enumerate(halves)
    ]
    got = decontaminate.summarize(*block(docs), queries, [n for n, _ in items])
    assert [g[:4] for g in got] == [brute_matches(d, items, 4) for d in docs]
    for text, (_, _, _, longest, at) in zip(docs, got):
        if longest:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))[at : at + longest]
            assert any(" ".join(words) in re.sub(r"[-.\n ]+", " ", lowered(t)) for _, t in items)


def test_no_benchmark():
    assert decontaminate.summarize(*block(["a b", ""]), [], []) == [(2, 0, [], 0, None), (0, 0, [], 0, None)]


def test_suffixes_are_sorted():
    words = np.random.default_rng(0).integers(1, 4, 200)
    words = np.concatenate([words, np.zeros(20, int)])
    order = decontaminate.suffix_array(words, np.arange(200), 13)
    keys = [tuple(words[p : p + 13]) for p in order]
    assert keys == sorted(keys)


def test_slide_min():
    values = np.random.default_rng(1).integers(0, 50, 37).astype(np.uint64)
    for width in (1, 2, 5, 36, 37):
        wanted = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert substrings.slide_min(values, width).tolist() == wanted


def test_equal_strings_have_equal_anchors():
    pick = random.Random(5)
    shared = "".join(pick.choice("abc") for _ in range(40))
    texts = ["".join(pick.choice("abc") for _ in range(n)) + shared + "z" * n for n in (0, 3, 17, 60)]
    data, starts = block(texts)
    text, first, size, lead, core, span = substrings.anchors(data, starts, 40, 20)
    found = set()
    for k, (t, n) in enumerate(zip(texts, (0, 3, 17, 60))):
        mine = (text == k) & (first <= n) & (n < first + size)
        assert mine.sum() == 1
        found.add((int(first[mine][0] + lead[mine][0] - n), int(core[mine][0])))
    assert len(found) == 1
    covered = sum(size[text == 2].tolist())
    assert covered == len(texts[2]) - 39


@pytest.mark.parametrize("kind", ["uniform", "long", "halves", "few"])
def test_configurations_hold_everything(kind):
    random = np.random.default_rng(0)
    lengths = {
        "uniform": random.integers(1, 1025, 3000),
        "long": np.where(random.random(4000) < 0.7, random.integers(1, 300, 4000), random.integers(300, 1024, 4000)),
        "halves": np.r_[random.integers(500, 530, 800), random.integers(2, 40, 500)],
        "few": np.array([1, 1024, 512, 512, 513]),
    }[kind]
    need = np.bincount(lengths, minlength=1025)
    plan = packing.configurations(need)
    held = np.zeros(1025, int)
    for chosen, often in plan:
        assert chosen.sum() <= 1024
        np.add.at(held, chosen, often)
    assert (held == need).all()
    least = max(-(-lengths.sum() // 1024), (lengths > 512).sum())
    assert sum(often for _, often in plan) <= 1.06 * least + 1


def test_no_pieces():
    assert packing.configurations(np.zeros(1025, int)) == []
    assert len(packing.place_table([])["length"]) == 0


def test_knapsack_is_best():
    random = np.random.default_rng(3)
    for _ in range(20):
        value = np.r_[0, random.random(12) * (random.random(12) < 0.6)]
        chosen = packing.knapsack(value, 12)
        assert chosen.sum() <= 12
        best = [0.0] * 13
        for room in range(1, 13):
            best[room] = max(best[room - 1], *(value[n] + best[room - n] for n in range(1, room + 1)))
        assert abs(value[chosen].sum() - best[12]) < 1e-9


def test_first_piece_is_the_short_one():
    row, piece, start, length = packing.cut_lengths(np.array([1, 4, 9, 8]), 4)
    assert row.tolist() == [0, 1, 2, 2, 2, 3, 3]
    assert piece.tolist() == [0, 0, 0, 1, 2, 0, 1]
    assert start.tolist() == [0, 0, 0, 1, 5, 0, 4]
    assert length.tolist() == [1, 4, 1, 4, 4, 4, 4]


@pytest.mark.parametrize("seed", range(60))
def test_grammar_round_trip(seed):
    random = np.random.default_rng(seed)
    n = int(random.integers(0, 400))
    ids = random.integers(0, random.integers(1, 12) + 1, n).astype(np.uint32)
    starts = np.r_[0, np.sort(random.integers(0, n + 1, random.integers(0, 5))), n]
    made = grammar.compress(ids, starts, 10, int(random.integers(1, 6)), 2)
    file = grammar.ShardFile(grammar.to_blob(made, [None, *range(len(starts) - 2)], starts, 7))
    assert (file.ids() == ids).all() and file.first_id == 7 and file.missing[0]
    for i in range(len(starts) - 1):
        assert (file.document(i) == ids[starts[i] : starts[i + 1]]).all()
    for i in range(0, n, 7):
        assert file.id_at(i) == ids[i]


def test_grammar_shrinks_repeats_and_counts_expansions():
    ids = np.tile(np.array([3, 1, 4, 1, 5, 9], np.uint32), 500)
    made = grammar.compress(ids, np.array([0, len(ids)]))
    assert len(made.symbols) < len(ids) / 8
    assert made.sizes[made.symbols[made.symbols >= made.base] - made.base].sum() <= len(ids)


def plain_repair(docs, least):
    """(symbols, rules) of Re-Pair as it is told: the most frequent pair first, one at a time."""
    docs, rules, top = [list(doc) for doc in docs], 0, max(max(doc) for doc in docs if doc) + 1
    while True:
        counts = collections.Counter()
        for doc in docs:
            last = None
            for i, pair in enumerate(zip(doc, doc[1:])):
                if pair == last and at == i - 1:
                    last = None
                    continue
                counts[pair] += 1
                last, at = pair, i
        best, often = max(counts.items(), key=lambda c: (c[1], c[0]), default=(None, 0))
        if often < least:
            return sum(map(len, docs)), rules
        for d, doc in enumerate(docs):
            out, i = [], 0
            while i < len(doc):
                if tuple(doc[i : i + 2]) == best:
                    out.append(top + rules)
                    i += 2
                else:
                    out.append(doc[i])
                    i += 1
            docs[d] = out
        rules += 1


@pytest.mark.parametrize("seed, least", [(0, 6), (1, 6), (2, 4), (3, 8)])
def test_grammar_is_as_small_as_plain_repair(seed, least):
    """Skewed words, phrases that recur, and a passage that most documents share."""
    random = np.random.default_rng(seed)
    words = lambda n: np.minimum(random.zipf(1.3, n), 400).astype(np.uint32)
    phrases, passage = [words(int(random.integers(2, 9))) for _ in range(40)], words(90)
    docs = []
    for d in range(30):
        parts = [words(30)]
        for _ in range(12):
            parts += [phrases[int(random.integers(40) * random.random())], words(int(random.integers(1, 6)))]
        docs.append(np.concatenate([*parts, passage] if d % 3 else parts))
    starts = np.r_[0, np.cumsum([len(doc) for doc in docs])]
    made = grammar.compress(np.concatenate(docs), starts, least=least)
    symbols, rules = plain_repair([doc.tolist() for doc in docs], least)
    assert 2 * len(made.symbols) + 12 * len(made.rules) <= 1.02 * (2 * symbols + 12 * rules)
    assert made.sizes.max() >= 64


def test_grammar_expands_to_any_length():
    """A passage of 3000 different ids in 20 documents becomes one symbol, or nearly."""
    passage = np.arange(3000, dtype=np.uint32)
    ids = np.concatenate([np.r_[np.uint32(5000 + d), passage] for d in range(20)]).astype(np.uint32)
    starts = np.arange(21) * 3001
    made = grammar.compress(ids, starts)
    assert made.sizes.max() > 1000 and len(made.symbols) <= 20 * 12
    file = grammar.ShardFile(grammar.to_blob(made, list(range(20)), starts, 0))
    assert (file.ids() == ids).all() and file.id_at(3001 * 7 + 1234) == 1233
    assert (file.document(19) == ids[starts[19] :]).all()


@pytest.mark.parametrize("rules, width", [(10, 2), (70000, 3)])
def test_symbols_of_two_and_three_bytes(rules, width):
    symbols = np.array([3, 1, rules + 3, 0], np.uint32)
    table = np.tile(np.array([1, 2], np.uint32), (rules, 1))
    made = grammar.Grammar(4, table, np.full(rules, 2, np.uint32), symbols, np.array([0, 4]))
    file = grammar.ShardFile(grammar.to_blob(made, [1], np.array([0, 5]), 0))
    assert file.symbols.tolist() == symbols.tolist() and file.ids().tolist() == [3, 1, 1, 2, 0]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        grammar.ShardFile(b"x" * 100)


def brute_repeats(texts, threshold):
    raw = [(t or "").encode() for t in texts]
    often = collections.Counter(b[i : i + threshold] for b in raw for i in range(len(b) - threshold + 1))
    rows = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - threshold + 1):
            if often[b[i : i + threshold]] > 1:
                gone[i : i + threshold] = [True] * threshold
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        rows.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return rows
