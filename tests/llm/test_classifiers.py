"""Both classifiers: held-out accuracy and defined cases."""

import math
import os
import re
from collections import Counter

import numpy as np
import pytest

from vigilcard.llm import quality, toxicity

SF_DIR = "/root/testdata/sf0.01"


def labelled(spark, seed, n=900):
    rng = np.random.default_rng(seed)
    plain, rude = [f"word{k}" for k in range(400)], ["vile", "louse", "blighter"]
    rows = []
    for k in range(n):
        toxic, bad = rng.random() < 0.2, rng.random() < 0.2
        words = [plain[j] for j in rng.zipf(1.3, rng.integers(5, 120)) % 400]
        if toxic:
            for w in rng.choice(rude, 2):
                words.insert(rng.integers(0, len(words)), str(w))
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        rows.append((k, text, "en", int(not bad), int(toxic), "extra", 0.5))
    odd = [(None, "no id", "en", 1, 0, "", 0.0), (n, None, None, None, None, "", 0.0), (n + 1, "", "en", 1, 1, "", 0.0), (n + 2, "vile " * 50_000, "en", None, None, "", 0.0)]
    return spark.createDataFrame(rows + odd + odd[1:2], "doc_id long, text string, lang string, quality int, toxic int, whole string, score double")


@pytest.mark.parametrize("module,column,cut", [(toxicity, "toxic", 0.5), (quality, "quality", 0.7)])
def test_held_out_accuracy(spark, module, column, cut):
    df = labelled(spark, 1)
    learn = df.where("doc_id % 4 <> 0").selectExpr("doc_id", f"{column} AS label").where("label IS NOT NULL")
    scored = module.score(df, module.fit(df, learn))
    assert scored.columns == [c for c in df.columns if c != "score"] + ["score"]
    rows = scored.collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 4 == 0]
    assert sum((r.score >= cut) == r[column] for r in held) >= 0.93 * len(held)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_empty_and_one_sided(spark, module):
    df = labelled(spark, 2, 40)
    none = df.selectExpr("doc_id", "toxic AS label").limit(0)
    assert all(0 <= r.score <= 1 for r in module.score(df, module.fit(df, none)).collect())
    empty = df.limit(0)
    assert module.score(empty, module.fit(empty, none)).count() == 0
    ones = df.where("doc_id IS NOT NULL").selectExpr("doc_id", "1 AS label").distinct()
    assert all(r.score > 0.5 for r in module.score(df, module.fit(df, ones)).collect())


def test_shared_backoff_is_neutral_for_unknown_words(spark):
    df = labelled(spark, 3)
    model = toxicity.fit(df, df.where("toxic IS NOT NULL AND doc_id IS NOT NULL").selectExpr("doc_id", "toxic AS label"))
    index = model.index()
    rude, unknown = (model.features(t, index)[1] for t in ("vile", "zzyzx"))
    assert rude > 3 and abs(unknown) < 1.5


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not here")
def test_quality_on_the_given_tables(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [r for r in quality.query(spark, SF_DIR).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.88 * len(rows)


def plain_kneser_ney(counted, everything, texts, window):
    """Ratios of ``texts`` by dictionaries: whole text and best window."""
    words = [(re.findall(r"\w+", t.lower()) if t else [], y) for t, y in counted]
    stems = lambda w: [w, *(w[:k] + "*" for k in (7, 6, 5, 4) if len(w) > k)]
    held = Counter(form for ws, _ in words for form in {f for w in ws for f in stems(w)})
    least = max(2, round(math.log2(len(words)) / 2))
    known = {w for w, n in held.items() if n >= least}
    name = lambda w: next((f for f in stems(w) if f in known), "?")
    named = lambda t: [name(w) for w in re.findall(r"\w+", t.lower())] if t else []
    shared = Counter(w for t in everything for w in {"<", *named(t)})
    size, total = len(known) + 2, sum(shared.values())
    grams = [Counter(), Counter()]
    for ws, y in words:
        names = [name(w) for w in ws]
        grams[y].update(zip(["<", *names], names, strict=False))
    after = [Counter(), Counter()]
    kinds, ends = [Counter(), Counter()], [Counter(), Counter()]
    for y in (0, 1):
        for (a, b), n in grams[y].items():
            after[y][a] += n
            kinds[y][a] += 1
            ends[y][b] += 1

    def unigram(y, b):
        mass = sum(ends[y].values())
        spare = 0.75 * len(ends[y]) / mass if mass else 1.0
        return max(ends[y][b] - 0.75, 0) / max(mass, 1) + spare * (shared[b] + 1) / (total + size)

    def chance(y, a, b):
        backoff = 0.75 * (kinds[0][a] + kinds[1][a]) / (after[0][a] + after[1][a])
        return max(grams[y][a, b] - 0.75, 0) / max(after[y][a], 1) + backoff * unigram(y, b)

    for t in texts:
        names = named(t)
        ratios = [math.log(chance(1, a, b) / chance(0, a, b)) if grams[0][a, b] + grams[1][a, b] >= 4 * least
                  else math.log(unigram(1, b) / unigram(0, b)) for a, b in zip(["<", *names], names, strict=False)]
        width = min(window, len(ratios))
        spans = [sum(ratios[k : k + width]) / width for k in range(len(ratios) - width + 1)] if ratios else [0.0]
        yield (sum(ratios) / len(ratios) if ratios else 0.0), max(spans)


def test_kneser_ney_against_plain_python(spark):
    df = labelled(spark, 4, 300)
    learn = df.where("toxic IS NOT NULL AND doc_id IS NOT NULL").selectExpr("doc_id", "toxic AS label")
    model = toxicity.fit(df, learn)
    tuned = df.where("doc_id IS NOT NULL").selectExpr("doc_id", "pmod(xxhash64(doc_id, 'tune'), 4) = 0 AS tune").collect()
    tune, rows = {r.doc_id for r in tuned if r.tune}, df.collect()
    counted = [(r.text, r.toxic) for r in rows if r.doc_id is not None and r.toxic is not None and r.doc_id not in tune]
    texts = [r.text for r in rows if r.text is None or len(r.text) < 5000]
    wanted = list(plain_kneser_ney(counted, [r.text for r in rows], texts, model.window))
    index = model.index()
    assert np.allclose([model.features(t, index) for t in texts], wanted, atol=1e-9)
    assert len(model.bigram_keys) > 20 and model.window in (1, 2, 3, 4, 8)


def test_window_is_chosen_without_the_held_out_fold(spark):
    """Labels that are not given change nothing."""
    df = labelled(spark, 5, 300)
    learn = df.where("doc_id % 4 <> 0 AND toxic IS NOT NULL").selectExpr("doc_id", "toxic AS label")
    one = toxicity.fit(df, learn)
    other = toxicity.fit(df.withColumn("toxic", 1 - df.toxic), learn)
    assert one.window == other.window and np.array_equal(one.weights, other.weights)


def test_risk_is_minimised():
    """The plain risk, row by row, at the result is no larger than around it; and the part of
    unlabelled rows does not stay below zero."""
    rng = np.random.default_rng(6)
    model = quality.PuClassifier(edges=[np.array([0.0, 1.0]), np.array([0.5])])
    good, free = rng.normal(1, 1, (300, 2)), np.concatenate([rng.normal(1, 1, (200, 2)), rng.normal(-1, 1, (300, 2))])
    pos, unl = model.design(good), model.design(free)

    def risk(weights, prior):
        margin = lambda row: weights[0] + sum(weights[k] for k in row)
        soft = lambda z: math.log1p(math.exp(-z))
        plus = sum(soft(margin(r)) for r in pos) / len(pos)
        minus = sum(soft(-margin(r)) for r in unl) / len(unl) - prior * sum(soft(-margin(r)) for r in pos) / len(pos)
        return prior * plus + max(0.0, minus) + 1e-4 * sum(w * w for w in weights), minus

    quality._minimise(model, pos, unl, 0.4, steps=2000)
    least, minus = risk(model.weights, 0.4)
    around = [risk(model.weights + rng.normal(0, 0.3, len(model.weights)), 0.4)[0] for _ in range(40)]
    assert minus > 0 and least <= min(around) + 1e-4
    quality._minimise(model, pos, unl, 0.98, steps=2000)
    assert risk(model.weights, 0.98)[1] > -0.05


def test_a_row_without_id_is_not_held_out(spark, tmp_path):
    df = labelled(spark, 7, 60)
    df.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    df.select("doc_id", "quality", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    for module in (toxicity, quality):
        rows = module.query(spark, str(tmp_path)).collect()
        assert len(rows) == df.count() and {r.held_out for r in rows if r.doc_id is None} == {False}
