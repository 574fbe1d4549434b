"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary labelled texts, share vocabulary and
backoff. Levels: class bigram, class continuation unigram, shared unigram. The shared level
counts documents of the whole corpus and the backoff weights of contexts are shared too, so
that an expression the labelled rows hardly know has about one likelihood in both classes. A
word below a minimum of labelled documents counts as its longest frequent beginning of 4 to 7
letters, or else as one unknown word. A text is compared by its length-normalised log-likelihood
ratio, over the whole text and in its most toxic window of a few words, and a logistic curve
fitted on labelled rows that were not counted makes a probability of it. The window's length is
chosen on the same rows: each half of them judges the curve of the other, and the least loss wins.

The labelled rows are a bounded sample: at most ``rows_per_class`` of each class, those with
the least hash of the id. Corpus counts cover every document.

Defined cases: a null text is an empty one; an empty text has the ratio 0 and so the curve's
value there; rows without label, id or text teach nothing, and a row without id is not held out;
repeated rows score alike; an empty table gives an empty result; without rows of both classes every score is the share of toxic
rows, or 0. Other columns of the documents are passed through by ``score``.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm.common import id_fold, limited_broadcast, pieces

_TOKEN = re.compile(r"\w+")
_STEMS = (7, 6, 5, 4)
DISCOUNT = 0.75
#: Word counts and pairs that a task holds before it hands them on, and texts it takes at a time.
HELD_WORDS, HELD_PAIRS, TEXTS = 100_000, 500_000, 128


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def with_stems(words: set[str]) -> set[str]:
    """The words and their beginnings of 4 to 7 letters, written ``abcd*``."""
    return words.union(*({w[:k] + "*" for w in words if len(w) > k} for k in _STEMS))


class Lexicon(dict):
    """Entry of a word: its own, else that of its longest known beginning, else 0 (unknown)."""

    def __missing__(self, word: str) -> int:
        return next((self[stem] for k in _STEMS if len(word) > k and (stem := word[:k] + "*") in self), 0)

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class KneserNey:
    """Log-likelihood ratios by word and by kept bigram. The name stands for the vocabulary, which
    is not changed once the model was sent to a task."""

    vocabulary: list[str] = field(default_factory=list)
    word_ratio: np.ndarray = field(default_factory=lambda: np.zeros(2))
    bigram_keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    bigram_ratio: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3))
    window: int = 2
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def index(self) -> Lexicon:
        return Lexicon((word, k + 2) for k, word in enumerate(self.vocabulary))

    def features(self, text: str | None, index: Lexicon, windows: tuple[int, ...] = ()) -> tuple[float, ...]:
        """Ratio per word over the whole text and in the window, of each length (default: the
        model's), where it is largest."""
        windows, found = windows or (self.window,), tokens(text)
        if not found:
            return (0.0,) * (1 + len(windows))
        ids = index.ids(found)
        before = np.concatenate(([1], ids[:-1]))
        ratio = self.word_ratio[ids]
        if len(self.bigram_keys):
            keys = before * len(self.word_ratio) + ids
            at = np.minimum(np.searchsorted(self.bigram_keys, keys), len(self.bigram_keys) - 1)
            ratio = np.where(self.bigram_keys[at] == keys, self.bigram_ratio[at], ratio)
        sums = np.concatenate(([0.0], np.cumsum(ratio)))
        widths = [min(window, len(ids)) for window in windows]
        return float(sums[-1] / len(ids)), *(float((sums[w:] - sums[:-w]).max() / w) for w in widths)

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.weights[:2] + self.weights[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


_LEXICONS: dict[str, Lexicon] = {}


def _lexicon(sent) -> Lexicon:
    """The index of a broadcast model, built once in a worker; that of another one is let go."""
    name = sent.value.name
    if name not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[name] = sent.value.index()
    return _LEXICONS[name]


def labelled_sample(documents: DataFrame, labels: DataFrame, rows_per_class: int) -> DataFrame:
    """Texts of at most ``rows_per_class`` labelled rows of each class: doc_id, text, label."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "label")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = [known.where(F.col("label") == k).orderBy(*order).limit(rows_per_class) for k in (0, 1)]
    both = chosen[0].unionByName(chosen[1])
    return documents.select("doc_id", "text").join(limited_broadcast(both, 2 * rows_per_class), "doc_id")


def fit(documents: DataFrame, labels: DataFrame, rows_per_class: int = 20_000, vocabulary: int = 200_000,
        bigrams: int = 500_000, windows: tuple[int, ...] = (1, 2, 3, 4, 8)) -> KneserNey:
    """Fits both models; ``labels`` has doc_id and label (1 toxic, 0 ordinary).

    ``vocabulary`` and ``bigrams`` bound what the driver holds: the words in most labelled
    documents and the bigrams counted most; a bigram is kept from four times the least number of
    documents of a word on. ``windows`` are the lengths to choose from.
    """
    rows = labelled_sample(documents, labels, rows_per_class)
    rows = rows.withColumn("tune", F.pmod(F.xxhash64("doc_id", F.lit("tune")), F.lit(4)) == 0)
    model = KneserNey(window=windows[0])

    def word_counts(batches):
        counts, sizes = Counter(), Counter()
        for batch in pieces(batches, TEXTS):
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                sizes[label] += 1
                counts.update((w, label) for w in with_stems(set(tokens(text))))
                if len(counts) > HELD_WORDS:
                    yield _count_rows(counts)
                    counts.clear()
        yield _count_rows(counts)
        yield _count_rows(Counter({(None, k): n for k, n in sizes.items()}))

    counted = rows.where("NOT tune").select("text", "label").mapInArrow(word_counts, "word string, label int, n long")
    counted = counted.groupBy("word").agg(
        F.sum(F.expr("IF(label = 1, n, 0)")).alias("toxic"), F.sum(F.expr("IF(label = 0, n, 0)")).alias("ordinary"))
    counted = counted.withColumn("n", F.expr("toxic + ordinary"))
    sizes = counted.where("word IS NULL").first()
    if sizes is None or not sizes["toxic"] or not sizes["ordinary"]:
        share = sizes["toxic"] / sizes["n"] if sizes is not None and sizes["n"] else 0.0
        model.weights = np.array([0.0, 0.0, np.log((share + 1e-9) / (1 - share + 1e-9))])
        return model
    least = max(2, round(np.log2(sizes["n"]) / 2))
    kept = counted.where((F.col("n") >= least) & F.col("word").isNotNull())
    kept = kept.orderBy(F.desc("n"), "word").limit(vocabulary).toArrow().to_pandas()
    model.vocabulary = kept["word"].tolist()
    shared = _corpus_frequencies(documents, model.vocabulary)
    _fit_ratios(model, rows.where("NOT tune"), shared, 4 * least, bigrams)
    _fit_curve(model, rows.where("tune"), windows)
    return model


def _count_rows(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in counts], pa.string()), pa.array([k for _, k in counts], pa.int32()),
         pa.array(list(counts.values()), pa.int64())], names=["word", "label", "n"])


def _corpus_frequencies(documents: DataFrame, vocabulary: list[str]) -> np.ndarray:
    """Documents of the whole corpus that hold each word; at 0 unknown words, at 1 starts."""
    size, block = len(vocabulary) + 2, 8192
    sent = documents.sparkSession.sparkContext.broadcast(KneserNey(vocabulary))

    def frequencies(batches):
        index, total = _lexicon(sent), np.zeros(size, np.int64)
        for batch in pieces(batches, TEXTS):
            found = [np.unique(index.ids(list(set(tokens(text))))) for text in batch["text"].to_pylist()]
            total += np.bincount(np.concatenate(found), minlength=size)
            total[1] += len(found)
        used = np.flatnonzero(np.add.reduceat(total, np.arange(0, size, block)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([total[k * block : (k + 1) * block].tolist() for k in used], pa.list_(pa.int64()))],
            names=["block", "n"])

    parts = documents.select("text").mapInArrow(frequencies, "block int, n array<long>")
    parts = parts.select("block", F.posexplode("n").alias("k", "n")).groupBy("block", "k").agg(F.sum("n").alias("n"))
    rows = parts.where("n > 0").select((F.col("block") * block + F.col("k")).alias("word"), "n").toArrow().to_pandas()
    total = np.zeros(size)
    total[rows["word"].to_numpy()] = rows["n"].to_numpy()
    return total


def _fit_ratios(model: KneserNey, rows: DataFrame, shared: np.ndarray, least: int, bigrams: int) -> None:
    size = len(model.vocabulary) + 2
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def pairs(batches):
        index = _lexicon(sent)
        held: list[np.ndarray] = []
        for batch in pieces(batches, TEXTS):
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                ids = index.ids(tokens(text))
                held.append((np.concatenate(([1], ids))[:-1] * size + ids) * 2 + label)
            if sum(map(len, held)) > HELD_PAIRS:
                yield _pair_rows(held)
                held = []
        yield _pair_rows(held)

    counted = rows.select("text", "label").mapInArrow(pairs, "pair long, n long")
    counted = counted.groupBy("pair").agg(F.sum("n").alias("n"))
    counted = counted.select(F.expr("pair % 2").alias("label"), F.expr("pair DIV 2").alias("pair"), "n")
    from vigilcard.llm.common import stage

    counted = stage(counted, "toxicity-bigrams")
    contexts = counted.groupBy("label", F.expr(f"pair DIV {size}").alias("word")).agg(
        F.sum("n").alias("n"), F.count("*").alias("kinds")).toArrow().to_pandas()
    sums = contexts.groupby("word")[["n", "kinds"]].sum()
    backoff = np.ones(size)  # one weight for both classes: class sizes must not look like evidence
    backoff[sums.index] = DISCOUNT * sums["kinds"] / sums["n"]
    endings = counted.groupBy("label", F.expr(f"pair % {size}").alias("word")).agg(F.count("*").alias("kinds")).toArrow().to_pandas()
    top = counted.groupBy("pair").agg(
        F.sum(F.expr("IF(label = 1, n, 0)")).alias("toxic"), F.sum(F.expr("IF(label = 0, n, 0)")).alias("ordinary"))
    top = top.where(f"toxic + ordinary >= {least}").orderBy(F.desc(F.expr("toxic + ordinary")), "pair").limit(bigrams).toArrow().to_pandas()
    top = top.sort_values("pair")
    background = (shared + 1) / (shared.sum() + size)
    by_word, totals = [], []
    for k in (0, 1):
        ends = _column(endings, k, "kinds", size)
        mass = max(ends.sum(), 1.0)
        spare = DISCOUNT * np.count_nonzero(ends) / mass if ends.any() else 1.0
        by_word.append(np.maximum(ends - DISCOUNT, 0) / mass + spare * background)
        totals.append(_column(contexts, k, "n", size))
    model.word_ratio = np.log(by_word[1]) - np.log(by_word[0])
    key = top["pair"].to_numpy(np.int64)
    context, word = key // size, key % size
    chance = [
        np.maximum(top[name].to_numpy(float) - DISCOUNT, 0) / np.maximum(totals[k][context], 1) + backoff[context] * by_word[k][word]
        for k, name in enumerate(("ordinary", "toxic"))]
    model.bigram_keys, model.bigram_ratio = key, np.log(chance[1]) - np.log(chance[0])


def _pair_rows(held: list[np.ndarray]) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])


def _column(rows, label: int, name: str, size: int) -> np.ndarray:
    out, rows = np.zeros(size), rows[rows["label"] == label]
    out[rows["word"].to_numpy(np.int64)] = rows[name].to_numpy()
    return out


def _fit_curve(model: KneserNey, rows: DataFrame, windows: tuple[int, ...]) -> None:
    """Chooses the window and fits the curve over its two ratios."""
    rows = rows.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0)
    found = _with_features(rows, model, ["label", "half"], windows=windows).toArrow().to_pandas()
    y, half = found["label"].to_numpy(float), found["half"].to_numpy(bool)
    if len(set(y)) < 2:
        model.weights = np.array([0.0, 8.0, -8.0])
        return
    choices = [np.column_stack([found["whole"], found[f"peak_{w}"], np.ones(len(found))]) for w in windows]
    best = 0
    if all(len(set(y[part])) == 2 for part in (half, ~half)):
        best = int(np.argmin([_loss(x[~h], y[~h], _curve(x[h], y[h])) + _loss(x[h], y[h], _curve(x[~h], y[~h]))
                              for x in choices for h in [half]]))
    model.window, model.weights = windows[best], _curve(choices[best], y)


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic curve by Newton steps with a small ridge."""
    w, ridge = np.zeros(3), np.diag([1e-2, 1e-2, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
    return w


def _loss(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)).sum())


def _with_features(
    documents: DataFrame, model: KneserNey, keep: list[str], scored: bool = False, windows: tuple[int, ...] = ()
) -> DataFrame:
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select(*keep).schema
    for name in ["score"] if scored else ["whole", *(f"peak_{w}" for w in windows)]:
        schema = schema.add(name, "double")

    def run(batches):
        model, index = sent.value, _lexicon(sent)
        for batch in pieces(batches, TEXTS):
            x = np.array([model.features(t, index, windows) for t in batch["text"].to_pylist()]).reshape(batch.num_rows, -1)
            out = [pa.array(model.probability(x))] if scored else [pa.array(column) for column in x.T]
            yield pa.RecordBatch.from_arrays([batch[c] for c in keep] + out, names=schema.names)

    source = documents.select(*keep, "text") if "text" not in keep else documents.select(*keep)
    return source.mapInArrow(run, schema)


def score(documents: DataFrame, model: KneserNey, keep: list[str] | None = None) -> DataFrame:
    """Every document's probability of being toxic, in a column ``score`` after ``keep``
    (default: all columns but an older ``score``)."""
    kept = [c for c in documents.columns if c != "score"] if keep is None else keep
    return _with_features(documents, model, kept, scored=True)


def training_labels(labels: DataFrame, column: str, folds: int, held_out: int) -> DataFrame:
    """Labels that may be learnt from: rows outside the held-out fold."""
    return labels.where(id_fold(folds) != held_out).select("doc_id", F.col(column).cast("int").alias("label"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: toxicity of every document; crc32 of the id modulo 5 = 0 is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, training_labels(labels, "toxic", 5, 0))
    scored = score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", F.coalesce(id_fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
