"""Binary-code near-duplicates against all cosines."""

import math

import numpy as np
import pytest

from vigilcard.llm import embedding_dedup as dedup
from vigilcard.llm.common import Forest

SCHEMA = "vec_id long, embedding array<double>, v string"


def brute(rows, threshold=0.9):
    good = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    ids = sorted(good)
    width = max(len(good[i]) for i in ids)
    unit = np.array([np.pad(good[i] / np.linalg.norm(good[i]), (0, width - len(good[i]))) for i in ids])
    length = np.array([len(good[i]) for i in ids])
    near = (unit @ unit.T >= threshold - 1e-12) & (length[:, None] == length)
    forest = Forest(len(ids))
    for a, b in zip(*np.nonzero(near), strict=True):
        forest.union(int(a), int(b))
    expected = {i: (0, i) for i, _ in rows}
    return expected | {i: (int(near[k].sum()) - 1, ids[forest.root(k)]) for k, i in enumerate(ids)}


def vectors(seed, groups, spread, dimension=24):
    rng = np.random.default_rng(seed)
    out = []
    for size in groups:
        centre = rng.standard_normal(dimension)
        out += [centre + spread * rng.standard_normal(dimension) * np.linalg.norm(centre) / math.sqrt(dimension) for _ in range(size)]
    out += [out[0].copy(), out[0] * 2]
    return [(int(i), [float(x) for x in v]) for i, v in enumerate(out, start=5)]


@pytest.mark.parametrize("block", [2048, 16])
def test_links_equal_all_cosines(spark, monkeypatch, block):
    monkeypatch.setattr(dedup, "BLOCK", block)
    odd = [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, []), (904, [1.0, None]), (905, [1.0, 2.0])]
    rows = vectors(1, [1] * 60 + [2] * 8 + [50], 0.15) + odd
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = {r.vec_id: r for r in dedup.deduplicate(df).collect()}
    assert {i: (r.n_links, r.component_id) for i, r in found.items()} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        rows += [(2 * k, x.tolist()), (2 * k + 1, (0.901 * x + math.sqrt(1 - 0.901**2) * y).tolist())]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = sum(r.n_links for r in dedup.deduplicate(df).collect())
    assert 0.9 * 600 <= found <= sum(n for n, _ in brute(rows).values())


@pytest.mark.parametrize("dimension", [16, 32, 64, 384])
@pytest.mark.parametrize("vectors", [600, 1_000_000, 30_000_000])
def test_recall_of_the_plan_at_any_size(vectors, dimension):
    rng = np.random.default_rng(6)
    x, y = rng.standard_normal((2, 4000, dimension))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + math.sqrt(1 - 0.9**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    bits, bands = dedup.band_plan(vectors, dimension, 0.9, 0.98)
    assert bits >= min(dimension, round(math.log2(vectors)) - 3)
    shared = (dedup.band_keys(x, bits, bands) == dedup.band_keys(y, bits, bands)).any(axis=1)
    assert shared.mean() >= 0.97


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    unit = rng.standard_normal((400, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    code, a, b = dedup.Codes(unit), np.repeat(np.arange(400), 400), np.tile(np.arange(400), 400)
    error = code.estimate(a, b) - np.einsum("ij,ij->i", unit[a], unit[b])
    assert abs(error.mean()) < 0.005
    assert (np.abs(error) <= code.slack[a]).mean() > 0.9999


def test_repeated_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 0.01]), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = sorted(((r.vec_id or -1), r.n_links, r.component_id) for r in dedup.deduplicate(df).collect())
    assert [(i, c) for i, _, c in found if i > 0] == [(1, 1), (1, 1), (2, 1), (3, 1)]
    assert dedup.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shared_id_that_is_no_representative(spark):
    rows = [(3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = sorted((r.vec_id, r.component_id) for r in dedup.deduplicate(df).collect())
    assert found == [(3, 3), (4, 3), (5, 3), (5, 3), (6, 6)]
