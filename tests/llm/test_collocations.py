"""Phrase mining against a plain version, and the HAT-trie."""

import random
import re
import sys
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from vigilcard.llm import collocations

SCHEMA = "doc_id long, text string, lang string, rank int, n long"


def plain(rows, least, longest, covered, top):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(words)
            counts.update((lang, tuple(words[i : i + n])) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
    often = {k: f for k, f in counts.items() if f >= least}
    out = {}
    for (lang, p), a in often.items():
        if len(p) < 2:
            continue
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(m == lang and len(q) > len(p) and inside(q) and 100 * f >= covered * a for (m, q), f in often.items()):
            continue
        cuts = [(2000000 * a // (often[lang, p[:k]] + often[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), often[lang, p[:k]], often[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, sizes[lang], -score)
        for lang, found in out.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def run(spark, rows, **parameters):
    documents = spark.createDataFrame([(k, t, lang, 1, 2) for k, (lang, t) in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in collocations.mine(documents, **parameters).collect())


def test_equals_the_plain_version(spark, monkeypatch):
    for name, small in (("BURST", 8), ("ENTRIES", 200), ("TOGETHER", 500), ("HELD", 20), ("PARTITION", 50)):
        monkeypatch.setattr(collocations, name, small)
    make = random.Random(5)
    words = ["New", "york", "Ärzte", "ohne", "x y", "the", "of", "中", "\x00b"]
    rows = [(make.choice(["en", "de", None]),
             "".join(make.choice(words) + make.choice([" ", " ", "  ", "\t", ", ", "\n", ".", " "]) for _ in range(make.randrange(60))))
            for _ in range(150)]
    rows += [("en", None), (None, ""), ("fr", "?!., \t"), ("en", "of the " * 3000), ("und", "new york " * 40)] + [("de", "a b c d e")] * 12
    for least, longest, covered, top in ((5, 4, 80, 2000), (12, 3, 50, 7)):
        found = run(spark, rows, least=least, longest=longest, covered=covered, top=top)
        assert found == plain(rows, least, longest, covered, top) and found


def test_empty_table_and_no_candidates(spark):
    assert run(spark, []) == [] and run(spark, [("en", "a b")]) == []


def test_products_beyond_64_bits(spark):
    big = 2**60
    frequent = spark.createDataFrame(
        [("en", [1], 2 * big), ("en", [2], big + 1), ("en", [1, 2], big), ("en", [3, 1, 2], big * 4 // 5)], "lang string, ids array<long>, f long")
    frequent = frequent.unionByName(spark.createDataFrame([("en", [3], big), ("en", [3, 1], big)], frequent.schema))
    found = {tuple(r.ids): r for r in collocations.scored_candidates(frequent, 80).collect()}
    assert (1, 2) in found  # 4/5 of the count, rounded down, is just below 80 %
    assert found[1, 2].score == 2000000 * big // (3 * big + 1)


@given(st.lists(st.tuples(st.binary(min_size=4, max_size=4), st.integers(1, 5)), max_size=300), st.integers(1, 6))
def test_trie_counts_and_spills_sorted_runs(entries, burst):
    trie, wanted, found = collocations.HatTrie(burst), Counter(), Counter()
    for k, (key, n) in enumerate(entries):
        trie.add([key], [n])
        wanted[key] += n
        for keys, counts in [*trie.spill(trie.size // 2)] if k % 50 == 49 else []:
            run_keys = [row.tobytes() for row in keys]
            assert run_keys == sorted(run_keys)
            found.update(dict(zip(run_keys, counts.tolist(), strict=True)))
    for keys, counts in trie.spill(0):
        found.update(dict(zip([row.tobytes() for row in keys], counts.tolist(), strict=True)))
    assert trie.size == 0 and found == wanted


def test_one_prefix_fills_many_partitions():
    """Phrases that begin with one word do not share a partition."""
    ids = np.array([w for k in range(4000) for w in (7, collocations.word_id(b"%d" % k))], np.uint64)
    every = np.full(2 ** (collocations.BITMAP - 3), 255, np.uint8)
    keys, _ = collocations.phrase_keys(ids, np.uint64(1), 2, every)
    led = Counter(k[0] >> 2 for k in keys if k[3:11] == (7).to_bytes(8, "big"))
    assert max(led.values()) < 4000 / 6


def lines_run(call):
    """What a call returns and how many lines of Python it runs."""
    lines = 0

    def trace(frame, event, _):
        nonlocal lines
        lines += event == "line"
        return trace

    before = sys.gettrace()
    sys.settrace(trace)
    try:
        found = call()
    finally:
        sys.settrace(before)
    return found, lines


def test_no_line_of_python_for_each_phrase():
    """Phrases become keys and enter the trie as arrays: a step for each key took most of the CPU time."""
    ids = np.arange(1, 100_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    every = np.full(2 ** (collocations.BITMAP - 3), 255, np.uint8)
    trie = collocations.HatTrie()
    for _ in range(2):
        _, lines = lines_run(lambda: trie.add(*collocations.phrase_keys(ids, np.uint64(1), 2, every)))
        assert lines < 50_000
    assert trie.size == 99_999
    runs, lines = lines_run(lambda: list(trie.spill(0)))
    assert lines < 50_000 and all((counts == 2).all() for _, counts in runs)


def test_single_words_leave_a_task_as_runs(spark):
    """Words are counted like longer phrases, and not by a row for each distinct word of a task."""
    rows = [(k, f"w{k} the, w{k + 1} the", "en", 1, 2) for k in range(1000)]
    words = collocations.count_phrases(spark.createDataFrame(rows, SCHEMA), 1, 2, None, 4000).collect()
    assert Counter(len(r.ids) for r in words) == {0: 1, 1: 1000}
    assert {r.f for r in words if not r.ids} == {4000} and max(r.f for r in words if r.ids) == 2000


@given(st.lists(st.text(alphabet="aZÄ中\x00\x1c. \t\n,\r", max_size=40), max_size=5))
def test_words_of_many_texts_at_once(texts):
    texts = [*texts, "x" * 300, "y" * 17 + " " + "x" * 300]
    joined, start, size, ids = collocations.words_and_breaks([t.encode() for t in texts])
    found = [None if i == 0 else joined[a : a + n].decode() for a, n, i in zip(start.tolist(), size.tolist(), ids.tolist(), strict=True)]
    wanted = [re.findall(r"[^ \t]+", piece) for t in texts for piece in re.split(r"[.,;:!?\n-\r]", t.replace("Z", "z"))]
    pieces = [[]]
    for word in found:
        pieces += [[]] if word is None else []
        if word is not None:
            pieces[-1].append(word)
    assert [p for p in pieces if p] == [p for p in wanted if p]
    assert len({w: i for w, i in zip(found, ids.tolist(), strict=True) if w}) == len({i for i in ids.tolist() if i})
    assert all(collocations.word_id(w.encode()) == i for w, i in zip(found, ids.tolist(), strict=True) if w)


@given(st.lists(st.binary(min_size=11, max_size=11), max_size=60), st.binary(min_size=8, max_size=8), st.booleans())
def test_order_of_keys_that_begin_alike(keys, head, all_alike):
    """Keys that share their first eight bytes, zeros at the end, and a key several times."""
    keys = [head + k[8:] if all_alike or i % 2 else k[:9] + b"\x00\x00" for i, k in enumerate(keys)] * 2
    order = collocations.sorted_order(np.array(keys, "S11"))
    assert [keys[i] for i in order] == sorted(keys)


@given(st.lists(st.tuples(st.binary(min_size=2, max_size=2), st.integers(1, 5)), min_size=1, max_size=400), st.integers(1, 50))
def test_keys_that_repeat_in_one_batch(entries, burst):
    trie, wanted = collocations.HatTrie(burst), Counter()
    keys, counts = [k for k, _ in entries], [n for _, n in entries]
    for _ in range(2):
        trie.add(keys, counts)
        for key, n in entries:
            wanted[key] += n
    found = {row.tobytes(): n for rows, total in trie.spill(0) for row, n in zip(rows, total.tolist(), strict=True)}
    assert found == wanted
