"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector x, turned by a fixed random rotation, keeps one sign bit for each coordinate: its
code is the corner o of the cube nearest to it, and the stored factor <o, x> corrects estimates
made from it. For a second unit vector y, <o, y> / <o, x> estimates <x, y> without bias over
rotations, with an error that is at most sqrt((1 - <o, x>^2) / <o, x>^2) * e / sqrt(d - 1) but
for a chance of 2 exp(-e^2 / 2) or so. A pair whose estimate plus bound stays below the
threshold is dropped; every other pair has its cosine recomputed in double precision, so no
link is ever below the threshold.

Candidates come from codes too. ``bands`` bands take ``bits`` bits each, no bit twice, from as many
rotations as that needs; vectors that agree in a band share a bucket. ``bits`` grows with the
logarithm of the number of vectors, so buckets stay small, and ``bands`` is set by the measured
chance of a miss so that a pair at the threshold shares a bucket with the chance ``recall``, at
any number of vectors. A pair counts in the first band it shares only.

Equal vectors are one class from the start. Buckets of more than ``BLOCK`` classes are cut into
blocks, and every pair of blocks is a task of its own, so no group is gathered whole. Tasks
return link counts and a spanning forest, never the pairs.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and rows
with a null vec_id, link with nothing; vectors of different length never link; rows that share
a vec_id are separate in counts and one vertex in components; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm.common import Forest, connected_components, shared_ids, stage

BLOCK = 2048
#: Standard deviations of the estimate's error that the confidence bound allows.
CONFIDENCE = 4.5


@lru_cache(maxsize=256)
def rotation(dimension: int, number: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    rng = np.random.Generator(np.random.PCG64([dimension, number]))
    q, r = np.linalg.qr(rng.standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=64)
def _missed(dimension: int, bits: int, threshold: float) -> np.ndarray:
    """Chance that a pair at the threshold shares none of the first 0, 1, 2, ... bands of a random
    rotation, measured on random pairs, plus two standard errors."""
    per, rng = dimension // bits, np.random.Generator(np.random.PCG64([dimension, bits]))
    rows, step = max(4_000, 40_000 // per), max(1, 1_000_000 // dimension)
    first = np.zeros(per + 1, np.int64)
    for start in range(0, rows, step):
        x, y = rng.standard_normal((2, min(step, rows - start), dimension))
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y *= math.sqrt(max(0.0, 1 - threshold**2)) / np.maximum(np.sqrt((y * y).sum(axis=1, keepdims=True)), 1e-300)
        same = (x > 0) == (threshold * x + y > 0)
        shared = same[:, : per * bits].reshape(len(x), per, bits).all(axis=2)
        first += np.bincount(np.where(shared.any(axis=1), shared.argmax(axis=1), per), minlength=per + 1)
    missed = 1 - np.concatenate(([0], np.cumsum(first[:-1]))) / rows
    return np.minimum(1.0, missed + 2 * np.sqrt(missed * (1 - missed) / rows))


@lru_cache(maxsize=64)
def band_plan(vectors: int, dimension: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a band and number of bands."""
    bits = min(max(4, min(round(math.log2(max(vectors, 2))) - 3, 40)), dimension)
    missed, allowed = _missed(dimension, bits, min(1.0, threshold)), max(1 - recall, 1e-9)
    per, whole = dimension // bits, 0  # rotations are independent, so their chances multiply
    if 0 < missed[-1] < 1:
        whole = max(0, math.ceil(math.log(allowed) / math.log(missed[-1])) - 1)
    return bits, max(1, whole * per + int(np.argmax(missed[-1] ** whole * missed <= allowed)))


def band_keys(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """Bucket of each vector in each band: bits of rotated coordinates, as integers. No two bands
    share a bit; a rotation gives as many bands as it has bits for."""
    dimension = unit.shape[1]
    per, powers = dimension // bits, 1 << np.arange(bits, dtype=np.int64)[::-1]
    keys = np.zeros((len(unit), bands), np.int64)
    for start in range(0, bands, per):
        count = min(per, bands - start)
        signs = unit @ rotation(dimension, start // per)[:, : count * bits] > 0
        keys[:, start : start + count] = signs.reshape(len(unit), count, bits) @ powers
    return keys


class Codes:
    """Unit vectors with their codes (corners of the cube in the first rotation), correction
    factors and, for the other side of an estimate, rotated coordinates."""

    def __init__(self, unit: np.ndarray) -> None:
        self.unit, self.turned = unit, unit @ rotation(unit.shape[1], 0)
        self.corner = np.where(self.turned > 0, 1.0, -1.0) / math.sqrt(unit.shape[1])
        self.factor = np.maximum((self.corner * self.turned).sum(axis=1), 1e-9)
        error = np.sqrt(np.maximum(1 - self.factor**2, 0)) / self.factor
        self.slack = CONFIDENCE * error / math.sqrt(max(unit.shape[1] - 1, 1))

    def estimate(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Unbiased estimates of the cosines of pairs."""
        return np.einsum("ij,ij->i", self.corner[a], self.turned[b]) / self.factor[a]

    def pairs(self, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that reach the threshold; the codes rule out, exact cosines decide."""
        open_ = self.estimate(a, b) + self.slack[a] >= threshold
        a, b = a[open_], b[open_]
        linked = np.einsum("ij,ij->i", self.unit[a], self.unit[b]) >= threshold
        return a[linked], b[linked]

    def blocks(self, left: np.ndarray, right: np.ndarray, threshold: float):
        """The same for all pairs of two index sets, 512 rows of the first at a time."""
        for start in range(0, len(left), 512):
            part = left[start : start + 512]
            estimate = self.corner[part] @ self.turned[right].T / self.factor[part][:, None]
            a, b = np.nonzero(estimate + self.slack[part][:, None] >= threshold)
            a, b = part[a], right[b]
            linked = np.einsum("ij,ij->i", self.unit[a], self.unit[b]) >= threshold
            yield a[linked], b[linked]


def bucket_links(found: Codes, buckets: np.ndarray, threshold: float):
    """Linked pairs inside the buckets; ``buckets`` is sorted. Small buckets of one size go
    together, a few hundred thousand pairs at a time."""
    edges = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1], [True])))
    lengths = np.diff(edges)
    for length in np.unique(lengths[lengths > 1]):
        starts = edges[:-1][lengths == length]
        if length > 64:
            for start in starts:
                at = np.arange(start, start + length)
                for a, b in found.blocks(at, at, threshold):
                    yield a[a < b], b[a < b]
            continue
        i, j = np.triu_indices(length, 1)
        step = max(1, 200_000 // len(i))
        for k in range(0, len(starts), step):
            at = starts[k : k + step, None]
            yield found.pairs((at + i).ravel(), (at + j).ravel(), threshold)


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vector(vectors: DataFrame):
    """The embedding; stored floats stay floats on their way, cosines are computed in double."""
    floats = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    return F.col("embedding") if floats else F.col("embedding").cast("array<double>")


def _classes(vectors: DataFrame) -> DataFrame:
    """Usable vectors, equal ones together: rep (smallest vec_id), copies, v."""
    good = vectors.select("vec_id", _vector(vectors).alias("v")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 "
        "AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(double(x)) < double('Infinity')) AND exists(v, x -> x <> 0)")
    return good.groupBy("v").agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies"))


def _deal(classes: DataFrame, total: int, threshold: float, recall: float) -> DataFrame:
    """A row for each class and band: dimension, band, bucket."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                rows = part["v"].to_pylist()
                for dimension in sorted({len(v) for v in rows}):
                    at = [k for k, v in enumerate(rows) if len(v) == dimension]
                    bits, bands = band_plan(total, dimension, threshold, recall)
                    keys = band_keys(_unit([rows[k] for k in at]), bits, bands)
                    row = np.repeat(np.array(at), bands)
                    yield pa.RecordBatch.from_arrays(
                        [part["rep"].take(pa.array(row)), part["copies"].take(pa.array(row)),
                         pa.array(np.full(len(row), dimension), pa.int32()),
                         pa.array(np.tile(np.arange(bands), len(at)), pa.int32()), pa.array(keys.ravel(), pa.int64())],
                        names=["rep", "copies", "dimension", "band", "bucket"])

    return classes.mapInArrow(run, "rep long, copies long, dimension int, band int, bucket long")


def links(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal vectors; (rep, n) counts of linked rows of other classes; a spanning
    forest of links between classes as (a, b)."""
    classes = stage(_classes(vectors), "embedding-classes")
    total = classes.count()
    dealt = stage(_deal(classes, total, threshold, recall), "embedding-bands")
    key = ["dimension", "band", "bucket"]
    sizes = dealt.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1")
    dealt = dealt.join(sizes, key).join(classes.select("rep", "v"), "rep")
    half = BLOCK // 2
    blocks = F.ceil(F.col("members") / half).cast("int")
    block = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    # Buckets that fit share tasks; the blocks of a larger one meet pair by pair.
    tasks = max(1, math.ceil(total / 512))
    whole = F.array(F.struct(F.pmod(F.xxhash64(*key), F.lit(tasks)).alias("x"), F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    cut = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda k: F.struct(F.xxhash64(*key).alias("x"), F.least(k, block).alias("i"), F.greatest(k, block).alias("j")))
    dealt = dealt.withColumn("at", F.explode(F.when(F.col("members") <= BLOCK, whole).otherwise(cut)))
    dealt = dealt.select("at.*", *key, block.alias("block"), "rep", "copies", "v")

    def search(table: pa.Table) -> pa.Table:
        rows = table.to_pandas()
        pair = int(rows["i"].iloc[0]) != int(rows["j"].iloc[0])
        counted: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for dimension, group in rows.groupby("dimension", sort=False):
            group = group.sort_values(["band", "bucket"], kind="stable")
            rep, copies, band = (group[c].to_numpy() for c in ("rep", "copies", "band"))
            unit = _unit(group["v"].tolist())
            keys = band_keys(unit, *band_plan(total, int(dimension), threshold, recall))
            code = Codes(unit)
            if pair:
                sides = [np.flatnonzero(group["block"].to_numpy() == group[c].iloc[0]) for c in "ij"]
                linked = code.blocks(*sides, threshold)
            else:
                linked = bucket_links(code, band.astype(np.int64) << 40 | group["bucket"].to_numpy(), threshold)
            forest, sums = Forest(len(rep)), np.zeros(len(rep), np.int64)
            for a, b in linked:
                first = (keys[a] == keys[b]).argmax(axis=1) == band[a]
                a, b = a[first], b[first]
                np.add.at(sums, a, copies[b])
                np.add.at(sums, b, copies[a])
                edges += [(int(rep[x]), int(rep[y])) for x, y in zip(a.tolist(), b.tolist(), strict=True) if forest.union(x, y)]
            for k in np.flatnonzero(sums):
                counted[int(rep[k])] = counted.get(int(rep[k]), 0) + int(sums[k])
        return pa.table({
            "a": pa.array([a for a, _ in edges] + list(counted), pa.int64()),
            "b": pa.array([b for _, b in edges] + [None] * len(counted), pa.int64()),
            "n": pa.array([None] * len(edges) + list(counted.values()), pa.int64())})

    found = stage(dealt.groupBy("x", "i", "j").applyInArrow(search, "a long, b long, n long"), "embedding-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    return classes, counts, found.where("b IS NOT NULL").select("a", "b")


def deduplicate(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    classes, counts, forest = links(vectors, threshold, recall)
    mine = vectors.select("vec_id", _vector(vectors).alias("v"))
    rows = mine.join(classes, "v", "left").select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("rep")).alias("rep"), "copies")
    rows = stage(rows, "embedding-rows")
    # A vec_id on rows with different vectors connects their classes.
    shared = shared_ids(rows.where("rep IS NOT NULL").select(F.col("vec_id").alias("id"), "rep"), "embedding-shared")
    groups = connected_components(forest.unionByName(shared), "embedding-components")
    return (
        rows.join(counts, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
        .select("vec_id", F.when(F.col("rep").isNull(), 0).otherwise(F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                F.coalesce("component", "rep", "vec_id").cast("long").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: links of cosine 0.9 or more between all embeddings."""
    return deduplicate(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All cosines, for tables whose ids are present and distinct.
ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN linked l ON l.a = r.other
)
SELECT e.vec_id, (SELECT count(*) FROM linked l WHERE l.a = e.vec_id) AS n_links, min(r.other) AS component_id,
       min(r.other) = e.vec_id AS kept
FROM embeddings e JOIN reached r ON r.vec_id = e.vec_id GROUP BY e.vec_id
"""
