"""The mix against its closed form, its targets against resharing round by round."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vigilcard.llm import source_mix

SCHEMA = "doc_id long, text string, source string, size string, row string"


def reshared(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Targets by dealing the excess again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    goal, left, full = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set()
    while left > 1e-9 and len(full) < len(names):
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        for s in open_:
            goal[s] += left * weight[s] / total
        left = 0.0
        for s in open_:
            if goal[s] >= epochs * sizes[s]:
                left += goal[s] - epochs * sizes[s]
                goal[s] = epochs * sizes[s]
                full.add(s)
    return goal


def table(spark, seed, sources, rows):
    rng = random.Random(seed)
    out = [(1, None, None, "a", "b"), (1, "", "s0", "a", "b"), (None, "x y", "s0", "a", "b"), (None, "x y", "s0", "a", "b")]
    for k in range(rows):
        source = "s0" if rng.random() < 0.4 else rng.choice(sources)
        out.append((k, " \n".join(["w"] * rng.choice([0, 1, 5, 40, 300])), source, "a", "b"))
    return spark.createDataFrame(out, SCHEMA), out


@pytest.mark.parametrize("seed,sources", [(1, ["s0", "s1", "s2", None]), (2, [f"s{k}" for k in range(9)]), (3, ["s0", "z"])])
def test_targets_and_limits(spark, seed, sources):
    df, rows = table(spark, seed, sources, 400)
    words, count = defaultdict(int), Counter()
    for _, text, source, *_ in rows:
        words[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        count[source] += 1
    goal, found, got = reshared(words), source_mix.taken(df).collect(), Counter()
    assert len(found) == len(rows)
    for r in found:
        assert r.target == pytest.approx(goal[r.source]) and r.source_size == words[r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(r.by_epoch)
        got[r.source] += r.taken
    assert got == {r.source: math.floor(r.target + 0.5) for r in found}
    again = source_mix.taken(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_apply_takes_what_the_mix_says(spark):
    df, _ = table(spark, 4, ["s0", "s1", "s2"], 300)
    taken, got = defaultdict(int), defaultdict(int)
    for r in source_mix.taken(df).collect():
        taken[(r.doc_id, r.source)] += r.taken
    applied = source_mix.apply(df)
    assert applied.columns == df.columns
    for r in applied.collect():
        got[(r.doc_id, r.source)] += len(r.text.split())
    assert dict(got) == {k: n for k, n in taken.items() if n}


def test_every_stretch_of_slots_has_the_shares(spark):
    df, _ = table(spark, 5, ["s0", "s1", "s2"], 300)
    goals, found = source_mix.schedule(df)
    goal = {r.sid: r.target / r.total for r in goals.collect()}
    by_slot = {r.slot: r.sid for r in found.where("slot IS NOT NULL").select("slot", "sid").distinct().collect()}
    for start in (0, 700, 2000):
        stretch = [by_slot[k] for k in range(start, start + 500) if k in by_slot]
        for sid, n in Counter(stretch).items():
            assert abs(n - goal[sid] * 500) <= 8


def test_many_slots(spark):
    rows = [("big", 800_000_000)] + [(f"s{k:03}", size) for k, size in enumerate([1, 400, 900, 1_700, 3_000, 6_000, 20_000, 60_000] * 12)]
    sized = spark.createDataFrame([(k, s, n) for k, (s, n) in enumerate(rows)], "doc_id long, source string, size long")
    goals = source_mix.targets(sized, share=1.0, epochs=1).cache()
    total = goals.agg({"total": "max"}).first()[0]
    found = source_mix.slots(spark, goals, total).cache()
    got = {r.sid: (r.n, r.blocks, r.last) for r in found.groupBy("sid").agg(
        F.count("*").alias("n"), F.countDistinct("block").alias("blocks"), F.max("block").alias("last")).collect()}
    for r in goals.collect():
        n = math.ceil(math.floor(r.target + 0.5) / 1024)
        assert got[r.sid] == (n, n, n - 1)
    assert found.agg(F.countDistinct("slot")).first()[0] == found.agg(F.max("slot")).first()[0] + 1


@pytest.mark.parametrize("words_per_range", [1, 50_000])
def test_small_sources_and_long_texts_get_their_targets(spark, monkeypatch, words_per_range):
    """Forty sources with a target of a few words beside one very long text, with any number of
    ranges of the hash."""
    monkeypatch.setattr(source_mix, "RANGE", words_per_range)
    rows = [(k, "w w w", f"s{k:02}", "", "") for k in range(40)] + [(99, "w " * 400_000, "t", "", ""), (100, "w " * 30, "t", "", "")]
    found = source_mix.taken(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.taken for r in found if r.source != "t"} == {6}
    long = [r for r in found if r.source == "t"]
    assert sum(r.taken for r in long) == math.floor(long[0].target + 0.5) > 500_000


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_a_few_places_are_all_taken(n):
    assert sorted(k * source_mix.lattice_step(n) % n for k in range(n)) == list(range(n))


@pytest.mark.parametrize("n", [600_001, 1_048_576, 7_324_219, 1_000_000_007])
def test_places_are_even_at_any_number_of_slots(n):
    step, places = source_mix.lattice_step(n), 50_000
    assert math.gcd(step, n) == 1
    at = sorted(k * step % n for k in range(places))
    assert max(b - a for a, b in zip(at, at[1:], strict=False)) <= 6 * n / places


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert source_mix.taken(df).count() == 0 and source_mix.apply(df).count() == 0
