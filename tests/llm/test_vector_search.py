"""Approximate nearest neighbours against brute force."""

import numpy as np
import pytest

from vigilcard.llm import vector_search as search

SCHEMA = "vec_id long, embedding array<double>, label string, rank int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "l", 1, 0.5) for i, x in rows], SCHEMA)


def brute(rows, k, every):
    ok = [(i, np.array(x, float)) for i, x in rows
          if i is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    out = []
    for at, (q, x) in enumerate(ok):
        if q % every:
            continue
        others = [(-float(search.cosines(x[None], y[None])[0]), i) for b, (i, y) in enumerate(ok) if b != at and len(y) == len(x)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(others)[:k])]
    return sorted(out)


def found(spark, rows, **parameters):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in search.nearest(frame(spark, rows), **parameters).collect())


def test_small_tables_are_exact(spark):
    make = np.random.default_rng(3)
    rows = [(k, make.normal(size=8).tolist()) for k in range(120)]
    rows += [(200 + k, rows[10][1]) for k in range(20)] + [(500, [2 * c for c in rows[10][1]]), (501, [1e300] * 8), (502, [1e-300] * 8)]
    rows += [(600, None), (610, []), (620, [0.0] * 8), (630, [1.0, None] * 4), (640, [float("nan")] * 8), (None, [1.0] * 8)]
    rows += [(700, [1.0, 2.0]), (710, [2.0, 1.0]), (720, [3.0])]
    assert found(spark, rows, every=10) == brute(rows, 5, 10)


def test_repeated_ids_and_rows(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [0.6, 0.8]), (51, [1.0, 0.0]), (52, [0.0, 1.0])]
    assert found(spark, rows) == brute(rows, 5, 50)


def test_empty_table(spark):
    assert found(spark, []) == [] and found(spark, [(50, [1.0])]) == []


@pytest.mark.parametrize("kind", ["random", "clusters", "tight"])
def test_recall_on_large_tables(spark, monkeypatch, kind):
    monkeypatch.setattr(search, "SMALL", 256)
    monkeypatch.setattr(search, "BLOCK", 200)
    make = np.random.default_rng(7)
    x = make.normal(size=(3000, 24))
    if kind != "random":
        x = make.normal(size=(60, 24))[make.integers(0, 60, 3000)] + x * 0.3
    if kind == "tight":
        x[:1500] = x[0] + x[:1500] * 1e-4
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got, wanted = found(spark, rows, every=10), brute(rows, 5, 10)
    assert len(got) == len(wanted)
    score = {(q, i): s for q, _, i, s in wanted}
    hits = [(q, i) for q, _, i, s in got if (q, i) in score]
    assert len(hits) >= 0.93 * len(wanted) and all(abs(s - score[q, i]) < 1e-12 for q, _, i, s in got if (q, i) in score)


def test_hot_vectors_get_whole_answers(spark):
    rows = [(k, [1.0, 2.0]) for k in range(2500)] + [(k, [1.0, k * 0.001]) for k in range(2500, 2600)]
    got = found(spark, rows, every=2)
    assert len(got) == 5 * 1300
    assert [r[2] for r in got if r[0] == 2] == [0, 1, 3, 4, 5] and [r[2] for r in got if r[0] == 2000] == [0, 1, 2, 3, 4]


def test_queries_that_meet_too_few_rows_meet_all(spark, monkeypatch):
    monkeypatch.setattr(search, "fit", lambda *_: {6: search.Plan(12, 1, 1)})
    rows = [(k, v.tolist()) for k, v in enumerate(np.random.default_rng(1).normal(size=(90, 6)))]
    got = found(spark, rows, every=10)
    assert len(got) == 45
    assert {r[0] for r in got} == {r[0] for r in brute(rows, 5, 10)}


def test_transform_and_probes():
    x = np.random.default_rng(2).normal(size=(50, 16))
    assert np.allclose(np.linalg.norm(search.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    for bits in (0, 1, 3, 5, 6, 9):
        probes = search.probes_of(x, 0, bits, 1 << bits)
        assert (probes[:, 0] == search.buckets_of(x, 0, bits)).all()
        assert all(len(set(row)) == 1 << bits for row in probes.tolist())


def test_bounds_hold():
    x = search.unit(np.random.default_rng(4).normal(size=(300, 20)))
    codes, ids = search.encode(x), np.arange(300)
    got = search.shortlist(ids[:30], codes[:30], ids, codes, 5)
    exact = x @ x.T
    for q, c, low, high in got:
        assert q == c or low <= exact[int(q), int(c)] <= high
    for q in range(30):
        best = set(np.argsort(-exact[q])[:6].tolist())
        assert best <= {int(c) for a, c in got[:, :2] if a == q}
