"""License retrieval against exact containment in every window."""

import random
import re

import pytest

from vigilcard.llm import license_scan


def shingles(text):
    words = re.findall("[a-z0-9]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def brute(rows):
    found = {}
    for doc_id, text in rows:
        own = shingles(text)
        for name, template in license_scan.TEMPLATES.items():
            want = set(shingles(template))
            m = len(want)
            width, step = m + -(-m // 2), m // 2 + 1
            shares = [(len(want & set(own[s : s + width])) / m, s) for s in range(0, len(own), step)]
            good = [(x, s) for x, s in shares if x >= 0.8]
            if good:
                found[(doc_id, name)] = (max(good)[0], len(good), min(s for _, s in good))
    return found


def test_scan_finds_whole_and_altered_notices(spark):
    rng = random.Random(3)
    rows = [(None, "Released under the MIT License."), (0, ""), (1, None), (2, "mit license"), (3, "x " * 100_000 + license_scan.TEMPLATES["MIT-grant"])]
    names = list(license_scan.TEMPLATES)
    for k in range(4, 400):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randint(0, 200))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            notice = license_scan.TEMPLATES[rng.choice(names)].split()
            if rng.random() < 0.4:
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = notice
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame([(*r, "l", 1) for r in rows], "doc_id long, text string, license string, m int")
    found = {(r.doc_id, r.license): (r.share, r.n_windows, r.first_word) for r in license_scan.scan(df).collect()}
    expected = brute(rows)
    assert set(found) <= set(expected)
    assert len(found) >= 0.99 * len(expected)
    assert {k for k, v in expected.items() if v[0] == 1.0} <= set(found)
    assert all(found[k][0] <= expected[k][0] and found[k][1] <= expected[k][1] for k in found)
    assert sum(found[k] == pytest.approx(expected[k]) for k in found) >= 0.97 * len(found)


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
