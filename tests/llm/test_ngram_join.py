"""The Jaccard join against all pairs of small sets."""

import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from vigilcard.llm import ngram_join
from vigilcard.llm.common import Forest, shingles, text_pieces, word_hashes


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent):
    """doc_id -> (set size, component), rows as (doc_id, text) with distinct ids."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    ids = sorted(sets)
    forest = Forest(len(ids))
    for a, b in itertools.combinations(range(len(ids)), 2):
        x, y = sets[ids[a]], sets[ids[b]]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            forest.union(a, b)
    return {d: (len(sets[d]), ids[forest.root(k)]) for k, d in enumerate(ids)}


def corpus(seed, groups=12, copies=9):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = ["", None, "  \n ", "one", "ONE", "one two three", "One\ttwo\x0bthree", "one two three four"]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 8, 30, 120]))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.randint(1, copies)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts, start=10))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (1, 50)])
def test_divide_skip_finds_all_components(n, percent):
    rows = [r for r in corpus(n) if shingle_set(r[1], n)]
    sets = [np.unique(np.array([hash(s) & (2**63 - 1) for s in shingle_set(t, n)], np.uint64)) for _, t in rows]
    forest = Forest(len(rows))
    for a, b in ngram_join.divide_skip(sets, percent):
        forest.union(a, b)
    expected = brute(rows, n, percent)
    assert [rows[forest.root(k)][0] for k in range(len(rows))] == [expected[i][1] for i, _ in rows]


@pytest.mark.parametrize("limits", [(48, 2048), (3, 8)])
def test_join_equals_all_pairs(spark, monkeypatch, limits):
    monkeypatch.setattr(ngram_join, "LIST", limits[0])
    monkeypatch.setattr(ngram_join, "BLOCK", limits[1])
    rows = corpus(5)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, size string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, 4, 85).collect()}
    assert found == brute(rows, 4, 85)


def test_repeated_and_missing_ids(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "p q r s t"), (7, "p q r s t"), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.component_id) for r in ngram_join.join(docs, 4, 85).collect() if r.doc_id is not None)
    assert found == [(3, 3), (3, 3), (7, 3), (9, 9), (9, 9)]
    assert sorted((str(r.doc_id), r.text) for r in ngram_join.keep_one(docs).collect()) == [
        ("3", "a b c d e"), ("9", None), ("None", "a b c d e")]


def test_shared_id_that_is_no_representative(spark):
    rows = [(3, "a b c d e"), (4, "p q r s t"), (5, "a b c d e"), (5, "p q r s t"), (6, "k l m n o"), (6, "p q r s t"), (1, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.component_id) for r in ngram_join.join(docs, 4, 85).collect())
    assert found == [(1, 1), (3, 3), (4, 3), (5, 3), (5, 3), (6, 3), (6, 3)]
    assert sorted(r.doc_id for r in ngram_join.keep_one(docs).collect()) == [1, 3]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(docs).count() == 0
    assert ngram_join.keep_one(docs).count() == 0


@pytest.mark.parametrize("n", [1, 4, 5])
def test_hashed_shingles_stand_for_word_sequences(n):
    rng = random.Random(n)
    texts = [None, "", " ", "a", "A b", "x" * 300 + " y", "\x00 \x00\x00", "a" * 8 + " " + "a" * 9 + " " + "a" * 17, "é É x\x1cy"]
    texts += ["".join(rng.choice("abC \n\t\x0bé") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    values, begins = shingles(*word_hashes([t.encode() if t is not None else None for t in texts]), n)
    meaning = {}
    for k, text in enumerate(texts):
        own, expected = values[begins[k] : begins[k + 1]].tolist(), shingle_set(text, n)
        assert own == sorted(set(own)) and len(own) == len(expected)
        assert meaning.setdefault(tuple(own), expected) == expected


def test_task_holds_few_words_and_no_table_of_them():
    """The hashes of ten million bytes of different words take no more than their own pieces."""
    text = pa.array([" ".join(f"w{k}x{j}" for j in range(1000)) for k in range(1000)])
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    tracemalloc.start()
    found = sum(len(shingles(*word_hashes(texts), 5)[0]) for _, texts in text_pieces([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 1000 * 996 and peak < 30e6


def test_divide_skip_probes_many_long_lists_at_once():
    """Sets of a hundred near copies: as many links as connect them, in a few steps per set."""
    base = np.arange(1, 4001, dtype=np.uint64)
    sets = [np.unique(np.append(base, np.uint64(10_000 + k))) for k in range(100)]
    calls, search = [], np.searchsorted
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ngram_join.np, "searchsorted", lambda *a, **k: calls.append(1) or search(*a, **k))
        found = ngram_join.divide_skip(sets, 80)
    assert len(found) == 99 and len(calls) < 100 * (4000 // ngram_join.PROBED + 3)
