"""Importance resampling against a plain version, and its edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st

from vigilcard.llm import resampling

SCHEMA = "doc_id long, text string, score string, rank int, buckets string"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_features(text, least_n=1, most_n=1):
    words = WORDS.findall(lowered(text))
    return [" ".join(words[i : i + n]) for n in range(least_n, most_n + 1) for i in range(len(words) - n + 1)], len(words)


def plain(rows, target, buckets, least_n, most_n, percent, least_words):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = {i: plain_features(text, least_n, most_n) for i, text in rows}
    s = Counter(bucket(f) for fs, _ in found.values() for f in fs)
    t = Counter(bucket(f) for text in target for f in plain_features(text, least_n, most_n)[0])
    big_s, big_t, out = sum(s.values()), sum(t.values()), {}
    for i, (fs, n) in found.items():
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n]
    able = sorted((i for i in out if out[i][4] >= least_words), key=lambda i: (-out[i][2], i))
    for k, i in enumerate(able[: percent * len(able) // 100]):
        out[i][3] = k + 1
    return {i: tuple(x[:4]) for i, x in out.items()}


def run(spark, rows, target, **parameters):
    documents = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    aimed = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(documents, aimed, **parameters)
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=repr)


def test_equals_the_plain_version(spark):
    texts = [" ".join(f"w{(i * k + k) % 17}" for k in range(5 + i % 40)) for i in range(60)]
    texts[:6] = [None, "", "ÀB-c d_E9\x00f" * 3, "ẞ É 中文 " * 9, "Z" * 5000, "a " * 30000]
    rows = list(enumerate(texts))
    for least_n, most_n, buckets in ((1, 1, 10_000), (1, 3, 50), (2, 2, 70_000)):
        wanted = plain(rows, texts[10:14], buckets, least_n, most_n, 30, 20)
        found = run(spark, rows, texts[10:14], buckets=buckets, least_n=least_n, most_n=most_n, percent=30)
        assert {r[0]: r[1:] for r in found} == wanted


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, None)]
    found = run(spark, rows, [], percent=100, least_words=3)
    assert sorted(r[4] for r in found if r[4] is not None) == [1, 2, 3]
    assert len({r[1:4] for r in found if r[0] == 1}) == 1
    assert [r[1:3] + r[4:] for r in found if r[0] == 2] == [(0, 0, None)]


def test_empty_tables(spark):
    assert run(spark, [], ["a"]) == []
    assert len(run(spark, [(1, "a")], [])) == 1


def test_drawn_documents_keep_their_columns(spark):
    documents = spark.createDataFrame([(k, "word " * 30, "x", 1, "y") for k in range(10)], SCHEMA)
    found = resampling.drawn(documents, documents.limit(1), percent=20)
    assert found.columns == documents.columns and found.count() == 2


@given(st.text(max_size=60))
def test_words_are_those_of_the_pattern(text):
    low, at = resampling.spans(text, resampling.splitter())
    assert resampling.windows(low, at, 1, 2) == plain_features(text, 1, 2)[0]
