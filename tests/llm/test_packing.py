"""Packing against a scan of all bins, and its constraints."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from vigilcard.llm import packing


def scan(rows, capacity, per_source):
    """Best fit by looking at every bin."""
    bins, out = [], [None] * len(rows)
    for k in sorted(range(len(rows)), key=lambda k: (-rows[k][0], k)):
        size, cluster, source = rows[k]
        fits = [b for b in bins if b["left"] >= size and cluster not in b["clusters"] and not (per_source and b["sources"][source] >= per_source)]
        best = min(fits, key=lambda b: (b["left"], b["since"]), default=None)
        if best is None:
            best = {"left": capacity, "clusters": set(), "sources": Counter(), "n": len(bins)}
            bins.append(best)
        out[k] = (best["n"], capacity - best["left"])
        best["left"] -= size
        best["clusters"].add(cluster)
        best["sources"][source] += 1
        best["since"] = scan.clock = scan.clock + 1
    return out


scan.clock = 0


@pytest.mark.parametrize("seed,per_source", [(1, 0), (2, 1), (3, 2), (4, 3)])
def test_search_finds_the_tightest_compatible_bin(seed, per_source):
    rng = random.Random(seed)
    rows = [(rng.randint(1, 60), rng.choice([0, 0, *range(1, 40)]), rng.choice("aaabc")) for _ in range(300)]
    assert packing.pack_pieces(rows, 100, per_source) == scan(rows, 100, per_source)


def test_pack(spark):
    rng = random.Random(7)
    rows = [(None, "same text here", None), (None, "same text here", None), (1, "", "a"), (2, None, "a"), (3, "w " * 250, "b"), (3, "w " * 250, "b")]
    rows += [(k, " ".join(["x"] * rng.choice([1, 5, 30, 100, 333])) + (f" {k}" if rng.random() < 0.7 else ""), rng.choice("aaab")) for k in range(10, 400)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, piece int, bin int")
    found = packing.pack(df, 100, 4, 60).collect()
    words = Counter()
    for i, t, _ in rows:
        words[i] += len((t or "").split())
    got, bins = Counter(), defaultdict(list)
    for r in found:
        got[r.doc_id] += r.n_words
        assert r.from_word == 100 * r.piece and 0 <= r.n_words <= 100 and (r.bin is None) == (r.n_words == 0)
        bins[r.bin].append(r)
    assert got == words
    text, source = {i: t for i, t, _ in rows}, {i: s for i, _, s in rows}
    for name, pieces in bins.items():
        if name is None:
            continue
        pieces.sort(key=lambda r: r.bin_start)
        assert sum(r.n_words for r in pieces) <= 100
        assert all(a.bin_start + a.n_words == b.bin_start for a, b in zip(pieces, pieces[1:], strict=False)) and pieces[0].bin_start == 0
        assert len({text[r.doc_id] for r in pieces}) == len(pieces)
        assert max(Counter(source[r.doc_id] for r in pieces).values()) <= 4
    assert sorted(map(str, packing.pack(df, 100, 4, 60).collect())) == sorted(map(str, found))


def test_near_copies_are_never_together(spark, tmp_path):
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*words[:-1], f"end{k}"]), f"s{k}") for k in range(6)]
    rows += [(10 + k, " ".join(f"v{k}x{j}" for j in range(100)), "t") for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.bin for r in packing.query(spark, str(tmp_path)).collect()}
    assert len(found) == 10 and len({found[k] for k in range(6)}) == 6


def test_rows_of_a_document_and_equal_texts_are_never_together(spark):
    rows = [(1, "a b c d e f", "s"), (1, "a b c", "t"), (2, "x y z", "s"), (None, "x y z", "t"), (None, "q r", "s"), (None, "u v", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = corpus_pipeline.pack(spark, df, "").collect()
    assert len({r.bin for r in found if r.doc_id == 1}) == 2
    assert len({r.bin for r in found if r.n_words == 3 and r.doc_id != 1}) == 2
    assert len({r.bin for r in found}) == 2


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
