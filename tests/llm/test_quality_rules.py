"""Base counts and distances against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from vigilcard.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def class_counts(text):
    out = []
    for pattern in rules.CLASSES.values():
        rest = re.sub(pattern.replace(r"\p{L}", r"[^\W\d_]"), "", text)
        out.append(len(text) - len(rest))
        text = rest
    return [*out, len(text)]


def divergence(p, q):
    keys = set(p) | set(q)
    term = lambda x, m: x * math.log2(x / m) if x > 0 else 0.0
    return sum(term(x, (x + y) / 2) + term(y, (x + y) / 2) for x, y in ((p.get(k, 0), q.get(k, 0)) for k in keys)) / 2


def shares(rows):
    classes, words, n = Counter(), Counter(), 0
    for text in rows:
        found = [w.lower() for w in WORD.findall(text)]
        n += len(found)
        classes.update(dict(enumerate(class_counts(text))))
        words.update(w if w in rules.COMMON else None for w in found)
    total = sum(classes.values())
    return {k: c / total for k, c in classes.items()}, {k: c / n for k, c in words.items()}


def texts(seed, n):
    rng = random.Random(seed)
    out = [("", "en"), (None, None), ("\n\n \x0b", "xx"), ("a b c d e f g h " * 40, "en"), ("é" * 5000, "fr")]
    for _ in range(n):
        lang = rng.choice(["en", "en", "fr", "xx", None])
        own = {"en": ["the", "of", "and", "cat", "Dog,"], "fr": ["le", "la", "de", "chat.", "été"]}.get(lang, ["foo", "Bar"])
        words = [rng.choice(own + [f"w{rng.randrange(200)}"]) for _ in range(rng.randint(1, 200))]
        if rng.random() < 0.1:
            words = [w.upper() + "!!#" for w in words]
        if rng.random() < 0.2:
            words += words[: rng.randint(5, 30)]
        out.append((rng.choice([" ", "  ", " \n", "\t"]).join(words) + rng.choice(["", "\n", "\nx\nx y\nx"]), lang))
    return out


def test_counts_distances_and_verdicts(spark):
    rows = texts(1, 150)
    df = spark.createDataFrame([(k, t, lang, "z", 1) for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, words string, n_words int")
    options = {"min_words": 30, "min_reference": 500, "class_limit": 0.12, "word_limit": 0.4, "short_slack": 0.5}
    found = {r.doc_id: r for r in rules.judge(df, **options).collect()}
    counts = {k: base(t) for k, (t, _) in enumerate(rows)}
    for k, expected in counts.items():
        r = found[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
    passed = [k for k in counts if not found[k].base_failed]

    def measured(good):
        by_lang = defaultdict(list)
        for k in good:
            by_lang[rows[k][1]].append(rows[k][0])
            by_lang[rules.ALL].append(rows[k][0])
        kept = {x: shares(t) for x, t in by_lang.items() if x == rules.ALL or x in rules.LANGUAGES and sum(len(WORD.findall(s)) for s in t) >= 500}
        out = {}
        for k, (text, lang) in enumerate(rows):
            if counts[k][0] >= 30:
                own, ref = shares([text]), kept.get(lang, kept[rules.ALL])
                out[k] = tuple(math.sqrt(divergence(p, q)) for p, q in zip(own, ref, strict=True))
        return out

    first = measured(passed)
    final = measured([k for k in passed if k in first and first[k][0] <= 0.24 and first[k][1] <= 0.8])
    for k, r in found.items():
        far = False
        if k in final:
            assert (r.class_distance, r.word_distance) == pytest.approx(final[k], abs=1e-6)
            far = r.class_distance > 0.12 + 0.5 / math.sqrt(r.n_words) or r.word_distance > 0.4
        else:
            assert r.class_distance is None and r.word_distance is None
        assert r.kept == (not r.base_failed and not far)


def test_any_language_has_its_own_reference(spark, tmp_path):
    rng = random.Random(5)
    russian, english = "и в не на я быть он с что а дом вода город книга".split(), "the of and to in is cat dog house water".split()
    some = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(some(english, 120) + ".", "en") for _ in range(60)] + [(some(russian, 120) + ".", "ru") for _ in range(30)]
    bad = [("#### $$$$ 12345 |||| " * 2 + some(["@@@@9", "%%%%1", "&&&&7", "~~~~3", "99"], 80), "ru") for _ in range(2)]
    rows += [*bad, (some(["ναι", "όχι", "και", "σπίτι"], 100), "el"), (some(russian, 100), None)]
    df = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in rules.query(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows) and all(found[k].kept and found[k].class_distance is not None for k in range(90))
    assert not any(found[k].kept for k in (90, 91))
    assert all(found[k].kept and found[k].class_distance is None for k in (92, 93))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert rules.judge(df).count() == 0
