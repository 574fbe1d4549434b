"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by fast Hadamard pseudo-rotations (three rounds of random signs and a
Walsh-Hadamard transform) and assigned to the nearest signed axis. A bucket of a table is the axes
of several rotations, the last one cut to fewer coordinates, so that a table has 2**bits
buckets. A query probes the buckets whose axes it misses by least, in all tables, and what it
meets there is ranked again by exact cosines of the original vectors.

How many bits, tables and probes a dimension needs is fitted on a bounded sample: the true
neighbours of at most ``SAMPLE`` queries, found in one pass over all rows, tell the rank at which
each of them would be probed; the cheapest plan that finds ``RECALL`` of them is taken. At its limit a
plan probes every bucket, so hard data cost time, never recall. Every vector is indexed.

On Spark:

* Equal vectors are one class, of which the ``k + 1`` smallest ids suffice for any answer; the
  group limit of the window combines them on the map side, so copies cost nothing.
* Through the tables go one-byte codes with scale and rounding error, not vectors. The estimate
  from two codes is off by no more than a bound, so a task drops what cannot be among the
  nearest; original vectors are fetched for the few pairs that are left.
* Buckets with many classes are cut into blocks that a query meets one by one. Only buckets beyond
  one part in ``HOT_SHARE`` of all entries and ``BLOCK`` classes count as such, so the list of them that tasks
  get has ``HOT_SHARE`` rows at most. The answers of classes with more than a thousandth of the
  queries, a thousand at most, are broadcast to them; the others are joined.
* A query that met fewer than ``k`` rows although there are more meets all of them, in blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
with a null vec_id, take no part; vectors of different length are not compared; a query's own row
is left out once, another row with its id or its vector is a candidate; a repeated query row is
answered each time; ties go to the smaller vec_id; with fewer rows than ``k + 1`` all are
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilcard.llm.common import stage

NEAREST, EVERY = 5, 50
#: Queries per dimension that fit the plan, the share of their neighbours to find, most probes of a table.
SAMPLE, RECALL, PROBES = 100, 0.97, 1024
#: Tables at most; classes of a dimension up to which one bucket holds all.
TABLES, SMALL = 8, 2048
BLOCK, HOT_SHARE = 4096, 20_000
#: Entries that one search task holds on average.
PART = 100_000


@dataclass(frozen=True)
class Plan:
    """Index of one dimension: ``tables`` of 2**``bits`` buckets, of which a query probes ``probes``."""

    bits: int = 0
    tables: int = 1
    probes: int = 1


# --- hashing --------------------------------------------------------------------------------


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (length a power of two), of unchanged norm. Adding
    and subtracting alone, so a row's result never depends on the rows beside it."""
    n, width = x.shape[1], 1
    while width < n:
        pairs = x.reshape(len(x), -1, 2, width)
        x = np.concatenate((pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]), axis=2).reshape(len(x), n)
        width *= 2
    return x / math.sqrt(n)


@lru_cache(maxsize=512)
def _signs(table: int, part: int, size: int) -> np.ndarray:
    return np.random.default_rng([11, table, part, size]).choice([-1.0, 1.0], (3, size))


def rotated(units: np.ndarray, table: int, part: int) -> np.ndarray:
    size = 1 << max(0, (units.shape[1] - 1).bit_length())
    x = np.zeros((len(units), size))
    x[:, : units.shape[1]] = units
    for signs in _signs(table, part, size):
        x = hadamard(x * signs)
    return x


def axis_bits(bits: int, dimension: int) -> list[int]:
    """Bits of the rotations of a table: whole cross-polytopes and a cut one for the rest."""
    full = max(1, (dimension - 1).bit_length()) + 1
    return [full] * (bits // full) + [bits % full] * (bits % full > 0)


def buckets_of(units: np.ndarray, table: int, bits: int) -> np.ndarray:
    """The bucket of each vector: its nearest signed axes."""
    found = np.zeros(len(units), np.int64)
    for part, b in enumerate(axis_bits(bits, units.shape[1])):
        x = rotated(units, table, part)[:, : 1 << (b - 1)]
        axis = np.abs(x).argmax(axis=1)
        found = (found << b) | (axis * 2 + (x[np.arange(len(x)), axis] < 0))
    return found


def probes_of(units: np.ndarray, table: int, bits: int, probes: int) -> np.ndarray:
    """The ``probes`` buckets of each vector with the least total of squared distances missed on
    their axes, least first; the vector's own bucket leads."""
    found, cost = np.zeros((len(units), 1), np.int64), np.zeros((len(units), 1))
    for part, b in enumerate(axis_bits(bits, units.shape[1])):
        x = rotated(units, table, part)[:, : 1 << (b - 1)]
        signed = np.stack((x, -x), axis=2).reshape(len(x), -1)
        missed = (signed.max(axis=1, keepdims=True) - signed) ** 2
        axes = np.argsort(missed, axis=1, kind="stable")[:, :probes]
        sums = cost[:, :, None] + np.take_along_axis(missed, axes, 1)[:, None, :]
        both = (found[:, :, None] << b) | axes[:, None, :]
        sums, both = sums.reshape(len(x), -1), both.reshape(len(x), -1)
        order = np.argsort(sums, axis=1, kind="stable")[:, :probes]
        found, cost = np.take_along_axis(both, order, 1), np.take_along_axis(sums, order, 1)
    return found


# --- vectors and codes ----------------------------------------------------------------------


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of each length in a column of valid vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows][:, None] + np.arange(size)]


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that brings their largest component near 1, which is exact."""
    _, power = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -power[:, None])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows, in double precision."""
    x, y = scaled(x), scaled(y)
    dot = lambda a, b: np.einsum("ij,ij->i", a, b)
    return dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def encode(units: np.ndarray) -> np.ndarray:
    """One byte per component behind scale and rounding error, as rows of bytes."""
    step = np.abs(units).max(axis=1, keepdims=True) / 127
    code = np.rint(units / step)
    error = np.sqrt(((units - code * step) ** 2).sum(axis=1, keepdims=True))
    head = np.hstack((step, error * 1.0001 + 1e-7)).astype(np.float32)
    return np.hstack((head.view(np.uint8).reshape(len(units), 8), code.astype(np.int8).view(np.uint8)))


def decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coded unit vectors and their errors."""
    head = codes[:, :8].copy().view(np.float32)
    return codes[:, 8:].view(np.int8).astype(np.float32) * head[:, :1], head[:, 1].astype(np.float64)


def shortlist(q: np.ndarray, q_codes: np.ndarray, c: np.ndarray, c_codes: np.ndarray, k: int) -> np.ndarray:
    """Candidates of each query that may be among its ``k`` nearest classes apart from its own, which always
    stays: rows of (query, candidate, low, high)."""
    (x, dx), (y, dy) = decode(q_codes), decode(c_codes)
    out = []
    for at in range(0, len(q), 256):
        mine = slice(at, at + 256)
        estimate = (x[mine] @ y.T).astype(np.float64)
        bound = dx[mine, None] * (1 + dy) + dy + 1e-5
        own = q[mine, None] == c
        low = np.where(own, -np.inf, estimate - bound)
        least = np.partition(low, len(c) - k, axis=1)[:, len(c) - k, None] if len(c) > k else np.full((len(low), 1), -np.inf)
        i, j = np.nonzero((estimate + bound >= least) | own)
        out.append(np.column_stack((q[mine][i], c[j], low[i, j], (estimate + bound)[i, j])))
    return np.concatenate(out)


def narrowed(found: np.ndarray, k: int) -> np.ndarray:
    """Each (query, candidate) once, without those that ``k`` others of the query surely surpass."""
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    new = np.concatenate((np.ones(min(1, len(found)), bool), (found[1:, :2] != found[:-1, :2]).any(axis=1)))
    found = found[new]
    found = found[np.lexsort((-found[:, 2], found[:, 0]))]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(found)), bool), found[1:, 0] != found[:-1, 0])))
    sizes = np.diff(np.append(starts, len(found)))
    least = np.where(sizes > k, found[np.minimum(starts + k - 1, len(found) - 1), 2], -np.inf)
    return found[(found[:, 3] >= np.repeat(least, sizes)) | np.isneginf(found[:, 2])]


# --- classes and plans ----------------------------------------------------------------------


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding and two hashes of the vectors that take part."""
    rows = embeddings.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    usable = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)"
    return rows.where(usable).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64("embedding", F.lit("second"))})


def classes_of(rows: DataFrame, k: int, every: int) -> DataFrame:
    """Distinct vectors: cid, h1, h2, dim, embedding, the k + 1 smallest ids, asked (holds a query)."""
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    first = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    merged = first.groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min_by("embedding", "vec_id").alias("embedding"))
    asked = rows.where(F.col("vec_id") % every == 0).select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    merged = merged.join(asked, ["h1", "h2"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    return stage(merged.withColumns({"dim": F.size("embedding"), "cid": F.monotonically_increasing_id()}), "search-classes")


def fit(classes: DataFrame, sizes: dict[int, int], k: int) -> dict[int, Plan]:
    """A plan for each dimension with more than ``SMALL`` classes, from a sample of its queries."""
    large = [dim for dim, n in sizes.items() if n > SMALL]
    if not large:
        return {}
    order = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("h1"), "cid"))
    sample = classes.where("asked").where(F.col("dim").isin(large)).select("dim", "cid", "embedding", order.alias("at"))
    held: dict[int, list] = {}
    for row in sample.where(F.col("at") <= SAMPLE).collect():  # SAMPLE vectors of a dimension
        held.setdefault(row["dim"], []).append((row["cid"], row["embedding"]))
    asked = {dim: (np.array([c for c, _ in rows]), unit(np.array([e for _, e in rows], float))) for dim, rows in held.items()}
    sent = classes.sparkSession.sparkContext.broadcast(asked)

    def nearest(batches):
        best: dict[int, list] = {}
        for batch in batches:
            cids = batch["cid"].to_numpy()
            for rows, x in matrices(batch["embedding"]):
                if x.shape[1] not in sent.value:
                    continue
                q, y = sent.value[x.shape[1]]
                x, c = unit(x), cids[rows]
                score = np.where(q[:, None] == c, -2.0, y @ x.T)
                top = np.argsort(-score, axis=1)[:, :k]
                for i in range(len(q)):
                    mine = best.get(int(q[i]), []) + [(score[i, j], x[j].tolist()) for j in top[i]]
                    best[int(q[i])] = sorted(mine, key=lambda t: -t[0])[:k]
        rows = [(q, s, x) for q, mine in best.items() for s, x in mine]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64()),
             pa.array([r[2] for r in rows], pa.list_(pa.float64()))], names=["q", "score", "x"])

    met = classes.where(F.col("dim").isin(list(asked))).select("cid", "embedding").mapInArrow(nearest, "q long, score double, x array<double>")
    met = met.withColumn("at", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("at") <= k)
    truth: dict[int, list] = {}
    for row in met.collect():  # k vectors of each query of the sample
        truth.setdefault(row["q"], []).append(row["x"])
    return {dim: _cheapest(q, y, truth, sizes[dim]) for dim, (q, y) in asked.items()}


def _cheapest(q: np.ndarray, units: np.ndarray, truth: dict[int, list], n: int) -> Plan:
    """The plan of least work that finds ``RECALL`` of the true neighbours."""
    of = np.concatenate([np.full(len(truth[int(c)]), i) for i, c in enumerate(q)])
    near = np.array([x for c in q for x in truth[int(c)]])
    plans = [(float(n), Plan())]
    for bits in range(2, max(3, math.ceil(math.log2(n / 16)) + 1)):
        most = min(PROBES, 1 << bits)
        rank = np.full((TABLES, len(of)), PROBES + 1)
        for table in range(TABLES):
            theirs = buckets_of(near, table, bits)
            probed = np.concatenate([probes_of(units[a : a + 8], table, bits, most) for a in range(0, len(units), 8)])
            hit = probed[of] == theirs[:, None]
            rank[table] = np.where(hit.any(axis=1), hit.argmax(axis=1) + 1, PROBES + 1)
        for tables in (1, 2, 4, TABLES):
            needed = np.sort(rank[:tables].min(axis=0))[math.ceil(RECALL * len(of)) - 1]
            if needed <= most:
                # A probe costs about as much as comparing with 64 candidates; no more rows than there are.
                met = min(n, tables * needed * n / 2**bits)
                plans.append((met + 64.0 * tables * needed + 8.0 * tables, Plan(bits, tables, int(needed))))
    return min(plans, key=lambda p: p[0])[1]


# --- search ---------------------------------------------------------------------------------


def _search(queries: DataFrame, classes: DataFrame, plans: dict[int, Plan], k: int) -> DataFrame:
    """(q, c) pairs of classes that may hold the ``k`` nearest found, the own class included."""
    spark = classes.sparkSession
    sent = spark.sparkContext.broadcast(plans)
    none = Plan()

    def keys(x: np.ndarray, probing: bool) -> np.ndarray:
        """Bucket keys (tables side by side) of vectors, one column per table and probe."""
        plan = sent.value.get(x.shape[1], none)
        found = []
        for table in range(plan.tables):
            own = probes_of(x, table, plan.bits, plan.probes) if probing else buckets_of(x, table, plan.bits)[:, None]
            found.append(own | table << 48)
        return np.concatenate(found, axis=1)

    def sizes(batches):
        for batch in batches:
            for _, x in matrices(batch["embedding"]):
                values, n = np.unique(keys(unit(x), False), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), x.shape[1], np.int32)), pa.array(values), pa.array(n)], names=["dim", "bucket", "n"])

    counted = stage(classes.select("embedding").mapInArrow(sizes, "dim int, bucket long, n long")
                    .groupBy("dim", "bucket").agg(F.sum("n").alias("n")), "search-buckets")
    total = counted.agg(F.sum("n")).first()[0] or 0
    large = counted.where(F.col("n") > max(BLOCK, total / HOT_SHARE)).collect()  # HOT_SHARE rows at most
    cut = spark.sparkContext.broadcast({(r["dim"], r["bucket"]): math.ceil(r["n"] / BLOCK) for r in large})
    parts = max(1, math.ceil(total / PART))

    def entries(probing: bool):
        def run(batches):
            for batch in batches:
                cids = batch["cid"].to_numpy()
                for rows, x in matrices(batch["embedding"]):
                    x, dim = unit(x), x.shape[1]
                    at = keys(x, probing)
                    codes = [c.tobytes() for c in encode(x)]
                    row, _ = np.indices(at.shape)
                    row, bucket = row.ravel(), at.ravel()
                    blocks = np.ones(len(row), np.int64)
                    mine = np.array([b for d, b in cut.value if d == dim], np.int64)
                    for i in np.flatnonzero(np.isin(bucket, mine)):
                        blocks[i] = cut.value[dim, int(bucket[i])]
                    if probing:  # a query meets every block
                        block = np.concatenate([np.arange(b) for b in blocks]) if len(blocks) else blocks
                        row, bucket = np.repeat(row, blocks), np.repeat(bucket, blocks)
                    else:
                        block = (cids[rows][row] * 0x9E3779B1 % 2**31) % blocks
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), dim, np.int32)), pa.array(bucket), pa.array(block.astype(np.int32)),
                         pa.array(cids[rows][row]), pa.array([codes[i] for i in row], pa.binary()),
                         pa.array(np.full(len(row), probing))], names=["dim", "bucket", "block", "cid", "code", "probe"])

        return run

    schema = "dim int, bucket long, block int, cid long, code binary, probe boolean"
    met = classes.select("cid", "embedding").mapInArrow(entries(False), schema).unionByName(
        queries.select("cid", "embedding").mapInArrow(entries(True), schema))
    part = F.pmod(F.xxhash64("dim", "bucket", "block"), F.lit(parts)).alias("part")

    def compare(table: pa.Table) -> pa.Table:
        dim, bucket, block = (table[c].to_numpy() for c in ("dim", "bucket", "block"))
        order = np.lexsort((block, bucket, dim))
        key = np.column_stack((dim, bucket, block))[order]
        cid, probe = table["cid"].to_numpy()[order], table["probe"].to_numpy()[order]
        code = table["code"].take(pa.array(order)).to_pylist()
        edges = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1), [True])))
        out = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            asks = probe[a:b]
            if asks.any() and not asks.all():
                codes = np.frombuffer(b"".join(code[a:b]), np.uint8).reshape(b - a, -1)
                found = shortlist(cid[a:b][asks], codes[asks], cid[a:b][~asks], codes[~asks], k)
                out.append(found)
                if sum(map(len, out)) > 1_000_000:
                    out = [narrowed(np.concatenate(out), k)]
        found = narrowed(np.concatenate(out), k) if out else np.zeros((0, 4))
        return pa.table({"q": pa.array(found[:, 0].astype(np.int64)), "c": pa.array(found[:, 1].astype(np.int64)),
                         "low": pa.array(found[:, 2]), "high": pa.array(found[:, 3])})

    near = met.select(part, "*").groupBy("part").applyInArrow(compare, "q long, c long, low double, high double")
    near = near.groupBy("q", "c").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    # The own class has no lower limit, so it is last in this order and never counts.
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("low"), "c"))
    near = near.withColumn("place", place)
    least = F.max(F.when(F.col("place") == k, F.col("low"))).over(Window.partitionBy("q"))
    near = near.withColumn("least", least).where("least IS NULL OR high >= least OR q = c")
    return near.select("q", "c")


def _answers(pairs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """q and its best k + 1 rows, nearest first: array of (score, vec_id, own)."""
    side = classes.select(F.col("cid").alias("c"), F.col("embedding").alias("y"), "ids")
    rows = pairs.join(side, "c").join(classes.select(F.col("cid").alias("q"), F.col("embedding").alias("x")), "q")
    schema = "q long, c long, ids array<long>, score double"

    def exact(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for (at, x), (_, y) in zip(matrices(batch["x"]), matrices(batch["y"]), strict=True):
                score[at] = cosines(x, y)
            yield pa.RecordBatch.from_arrays([batch["q"], batch["c"], batch["ids"], pa.array(score)], names=["q", "c", "ids", "score"])

    ids = F.col("ids").cast("array<long>").alias("ids")
    scored = rows.select("q", "c", ids, "x", "y").mapInArrow(exact, schema)
    single = scored.select("q", (F.col("q") == F.col("c")).alias("own"), F.explode("ids").alias("vec_id"), "score")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    best = single.withColumn("place", place).where(F.col("place") <= k + 1)
    listed = F.array_sort(F.collect_list(F.struct("place", "score", "vec_id", "own")))
    return best.groupBy("q").agg(listed.alias("near"))


def nearest(embeddings: DataFrame, k: int = NEAREST, every: int = EVERY) -> DataFrame:
    """The ``k`` nearest rows found for each row whose vec_id is divisible by ``every``: query_id,
    rank, vec_id, score."""
    rows = valid_vectors(embeddings)
    classes = classes_of(rows, k, every)
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    plans = fit(classes, sizes, k)
    asked = classes.where("asked")
    found = stage(_answers(_search(asked, classes, plans, k), classes, k), "search-answers")
    # Rows that a query of a dimension can find, k + 1 at most, its own among them.
    full = classes.groupBy("dim").agg(F.least(F.sum(F.size("ids")), F.lit(k + 1)).alias("full"))
    short = asked.join(full, "dim").join(found.select(F.col("q").alias("cid"), F.size("near").alias("n")), "cid", "left")
    short = stage(short.where("coalesce(n, 0) < full").select(*asked.columns), "search-short")
    if not short.isEmpty():
        again = _answers(_search(short, classes, {}, k), classes, k)
        found = stage(found.join(short.select(F.col("cid").alias("q")), "q", "left_anti").unionByName(again), "search-answers")
    named = found.join(classes.select(F.col("cid").alias("q"), "h1", "h2"), "q").select("h1", "h2", "near")
    return _to_rows(rows.where(F.col("vec_id") % every == 0).select("vec_id", "h1", "h2"), named, k)


def _to_rows(queries: DataFrame, answers: DataFrame, k: int) -> DataFrame:
    """Gives every query row the answer of its class, without the row itself."""
    key = ["h1", "h2"]
    queries = stage(queries, "search-queries")
    share = max(queries.count() / 1000, 1000)
    hot = queries.groupBy(*key).count().where(F.col("count") > share).drop("count")  # a thousand rows at most
    hot = F.broadcast(stage(hot, "search-hot"))
    many = queries.join(hot, key, "left_semi").join(F.broadcast(answers.join(hot, key, "left_semi")), key)
    few = queries.join(hot, key, "left_anti").join(answers, key)
    joined = many.unionByName(few)
    own = "array_position(transform(near, x -> x.own AND x.vec_id = vec_id), true)"
    rest = joined.selectExpr("vec_id AS query_id", f"slice(filter(near, (x, i) -> i + 1 <> {own}), 1, {int(k)}) AS near")
    ranked = rest.select("query_id", F.posexplode("near").alias("at", "hit"))
    return ranked.selectExpr("query_id", "CAST(at + 1 AS INT) AS rank", "hit.vec_id AS vec_id", "hit.score AS score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the five nearest of each vector whose id is divisible by 50."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
