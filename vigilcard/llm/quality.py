"""Quality classifier by positive-unlabelled learning.

The classifier sees trusted positives (rows labelled good) and unlabelled web text (documents
without a usable label); rows labelled bad are never used as examples. It minimises the
non-negative unbiased risk ``prior * R+(p) + max(0, R-(u) - prior * R-(p))`` with the logistic
loss: where the second part falls below zero, the step goes against it instead. The class
prior is estimated from the scores of first classifiers that tell positives from unlabelled
text: the share of unlabelled rows that score like positives on rows they were not fitted on.
That gives a ratio for each of several cuts; which quantile of them is the prior is chosen on an
inner fold of the given labels: a quarter of the positives and rows labelled bad, which judge
the candidates and are no examples. Rows whose labels are not given count as unlabelled text.

Features are shares and rates of the whole text: character classes, repeated words, lines and
neighbours, word lengths, symbols; each is cut into quantile bins of the sample, so that the
linear model can follow any shape. The fit uses a bounded sample (``rows`` positives and as
many unlabelled rows, those with the least hash of the id); scoring reads every whole text.

Defined cases: a null text is an empty one and gets a score like any other; rows without
label, id or text are unlabelled or unused, and a row without id is not held out; repeated rows score alike; an empty table gives an
empty result; without positives every score is 0, without unlabelled rows 1. ``score`` keeps
other columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm.common import id_fold, limited_broadcast, pieces

FEATURES = (
    "log_words", "upper", "digit", "space", "symbol", "comma", "period", "exclaim", "pipe", "line_rate",
    "unique_words", "same_neighbour", "top_word", "word_length", "long_words", "word_tail", "line_repeat",
    "shout_words", "symbol_words", "other_marks",
)
_SYMBOLS = re.compile(r"[#*$%&<>=~^_@{}\\\[\]]")
_MARKS = re.compile(r"[^\w\s]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")


def features(text: str | None) -> list[float]:
    """The values of FEATURES; an empty text has zeros."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars, kinds = len(text), {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    long_words = sum(c for w, c in kinds.items() if len(w) > 15)
    shout = sum(c for w, c in kinds.items() if len(w) > 1 and w.isupper())
    tail = sum(c for w, c in kinds.items() if len(w) > 1 and not (w[-1].isalnum() or w[-1] in ".,"))
    symbol_words = sum(c for w, c in kinds.items() if _SYMBOLS.search(w))
    symbols, marks = len(_SYMBOLS.findall(text)), len(_MARKS.findall(text))
    comma, period = text.count(","), text.count(".")
    return [
        np.log1p(n), len(_UPPER.findall(text)) / chars, len(_DIGIT.findall(text)) / chars, 1 - letters / chars,
        symbols / chars, comma / n, period / n, text.count("!") / n, text.count("|") / n, len(lines) / n,
        len(kinds) / n, sum(map(str.__eq__, words, words[1:])) / n, max(kinds.values()) / n, letters / n,
        long_words / n, tail / n, 1 - len(set(lines)) / len(lines), shout / n, symbol_words / n,
        (marks - symbols - comma - period) / n,
    ]


@dataclass
class PuClassifier:
    """Quantile bins of each feature and a weight for each bin."""

    edges: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    prior: float = 0.0

    def design(self, x: np.ndarray) -> np.ndarray:
        """Column numbers of the bins of each row."""
        start, out = 1, np.zeros((len(x), len(self.edges)), np.int64)
        for k, edges in enumerate(self.edges):
            out[:, k] = start + np.searchsorted(edges, x[:, k], side="right")
            start += len(edges) + 1
        return out

    def margin(self, at: np.ndarray) -> np.ndarray:
        return self.weights[0] + self.weights[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(self.design(x)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _minimise(model: PuClassifier, pos: np.ndarray, unl: np.ndarray, prior: float | None, steps: int = 400) -> None:
    """Adam on the non-negative unbiased risk; with ``prior`` None, plain logistic loss of
    positives against unlabelled rows."""
    size = model.edges and 1 + sum(len(e) + 1 for e in model.edges) or 1
    model.weights = np.zeros(size)
    first, second = np.zeros(size), np.zeros(size)

    def gather(at, values):
        out = np.bincount(at.ravel(), np.repeat(values, at.shape[1]), size)
        out[0] += values.sum()
        return out / len(at)

    for t in range(1, steps + 1):
        zp, zu = model.margin(pos), model.margin(unl)
        up_p, down_u, down_p = gather(pos, -_sigmoid(-zp)), gather(unl, _sigmoid(zu)), gather(pos, _sigmoid(zp))
        if prior is None:
            grad = up_p + down_u
        else:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            part = down_u - prior * down_p
            grad = prior * up_p + part if negative >= 0 else -part
        grad = grad + 2e-4 * model.weights
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        model.weights -= 0.05 * first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)


def _prior_ratios(model: PuClassifier, pos: np.ndarray, unl: np.ndarray) -> np.ndarray:
    """Cross-fitted: a classifier of one half ranks the other half's rows. Above a cut that
    most positives pass, the ratio of unlabelled to positive shares is the prior plus what bad
    text passes; a ratio for each of several cuts."""
    ratios = []
    for k in (0, 1):
        _minimise(model, pos[k::2], unl[k::2], None, steps=150)
        zp, zu = np.sort(model.margin(pos[1 - k :: 2])), np.sort(model.margin(unl[1 - k :: 2]))
        if len(zp) and len(zu):
            cuts = np.quantile(zp, np.linspace(0.02, 0.3, 15))
            ratios.append([(zu >= c).mean() / (zp >= c).mean() for c in cuts])
    return np.mean(ratios, axis=0) if ratios else np.array([0.5])


def _as_prior(ratios: np.ndarray, quantile: float) -> float:
    return float(np.clip(np.quantile(ratios, quantile), 0.05, 0.98))


def _estimate_prior(
    model: PuClassifier, pos: np.ndarray, unl: np.ndarray, bad: np.ndarray, quantiles: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75)
) -> float:
    """The prior by the quantile of the ratios whose classifier has the least loss on the inner
    fold, good and bad rows weighing alike; the first one if the fold lacks a class."""
    inner, rest, best = pos[::4], np.delete(pos, np.s_[::4], axis=0), quantiles[0]
    if len(rest) and len(bad):
        ratios, losses = _prior_ratios(model, rest, unl), []
        for quantile in quantiles:
            _minimise(model, rest, unl, _as_prior(ratios, quantile))
            losses.append(np.logaddexp(0, -model.margin(inner)).mean() + np.logaddexp(0, model.margin(bad)).mean())
        best = quantiles[int(np.argmin(losses))]
    return _as_prior(_prior_ratios(model, pos, unl), best)


def fit(documents: DataFrame, labels: DataFrame, rows: int = 20_000, bins: int = 12, prior: float | None = None) -> PuClassifier:
    """Fits on ``rows`` positives and ``rows`` unlabelled documents at most.

    ``labels`` has doc_id and label; only rows with label 1 are examples, and a document with
    any row in it is not unlabelled. ``prior`` is estimated unless given, with a quarter as many
    rows of label 0 in the inner fold.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    good = known.where("label = 1").orderBy(*order).limit(rows).withColumn("positive", F.lit(1))
    free = documents.where("doc_id IS NOT NULL").select("doc_id").join(known, "doc_id", "left_anti")
    free = free.distinct().orderBy(*order).limit(rows).withColumn("positive", F.lit(0))
    bad = known.where("label = 0").orderBy(*order).limit(rows // 4).withColumn("positive", F.lit(-1))
    chosen = [part.select("doc_id", "positive") for part in (good, free, bad)]
    chosen = chosen[0].unionByName(chosen[1]).unionByName(chosen[2])
    sample = documents.select("doc_id", "text").join(limited_broadcast(chosen, 3 * rows), "doc_id")

    def measure(batches):
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays(
                [batch["positive"], pa.array([features(t) for t in batch["text"].to_pylist()], pa.list_(pa.float64()))],
                names=["positive", "x"])

    found = sample.select("positive", "text").mapInArrow(measure, "positive int, x array<double>").toPandas()
    model, y = PuClassifier(), found["positive"].to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        model.weights = np.array([30.0 if (y == 1).any() else -30.0])
        return model
    every = np.array(found["x"].tolist())
    x, judged, y = every[y >= 0], every[y < 0], y[y >= 0]
    # Half of the bins part the good rows, half all rows: rare bad text gets bins of its own.
    at = np.linspace(0, 1, bins // 2 + 2)[1:-1]
    tails = np.concatenate(([0.01, 0.03], at, [0.97, 0.99]))
    model.edges = [np.unique(np.concatenate([np.quantile(x[y == 1, k], tails), np.quantile(x[:, k], at), x[y == 1, k].max(keepdims=True)]))
                   for k in range(x.shape[1])]
    where = model.design(x)
    pos, unl = where[y == 1], where[y == 0]
    if prior is None:
        prior = _estimate_prior(model, pos, unl, model.design(judged))
    model.prior = prior
    _minimise(model, pos, unl, prior)
    return model


def score(documents: DataFrame, model: PuClassifier, keep: list[str] | None = None) -> DataFrame:
    """Every document's quality in a column ``score`` after ``keep`` (default: all columns
    but an older ``score``)."""
    kept = [c for c in documents.columns if c != "score"] if keep is None else keep
    schema = documents.select(*kept).schema.add("score", "double")
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in pieces(batches):
            x = np.array([features(t) for t in batch["text"].to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + [pa.array(sent.value.probability(x))], names=schema.names)

    return documents.select(*dict.fromkeys([*kept, "text"])).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: quality of every document; crc32 of the id modulo 4 = 2 is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    usable = labels.where(id_fold(4) != 2).select("doc_id", F.col("quality").cast("int").alias("label"))
    scored = score(docs, fit(docs, usable), keep=["doc_id"])
    return scored.select(
        "doc_id", F.coalesce(id_fold(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
