"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two documents link when their sets of word n-grams have a Jaccard similarity of at least
``percent`` / 100. That needs an overlap of T shingles, T at least ``percent`` % of either set.
The search for a document therefore divides its inverted lists: all but the T - k longest are
short. The short lists are merged and only documents that occur in k of them go on (k = 3, less
for tiny sets); the long lists are probed for these candidates by binary search.

On Spark:

1. Each text becomes a sorted array of shingle hashes in a task. Texts with equal sets are one
   class from here on, so copies cost nothing.
2. Which lists are long is decided by one order of all shingles: those in more than ``LIST``
   documents last, the rest by hash. Frequent shingles are counted over the whole corpus and
   noted in a bitmap of fixed size, where a collision can only change the order; any order
   gives the same result. A class files its shingles of the short part, 15 to 20 % of them.
3. Postings are dealt by ranges of the shingle's hash. Each range finds the lists with two or
   more classes. Lists up to ``LIST`` classes give their pairs with counts, longer ones a star
   that stands for "may all be related". Pairs below k are dropped after adding up all ranges.
4. The connected groups of what remains are small. Each is searched exactly in memory: lists
   merged, long lists probed, pairs already known connected skipped. A group beyond ``BLOCK``
   classes is cut into blocks and every pair of its blocks is a task of its own.
5. Found links, at most one less than a group's members, go to connected components.

No pair is missed and none is estimated; equal 64-bit hashes stand for equal shingles.

Defined cases: a null or empty text has an empty set and links with nothing; a text of fewer
than n words is one shingle; rows that share a doc_id are one vertex, each returned; rows with
a null doc_id are not searched and have a null component; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm.common import (
    Forest, binaries, connected_components, limited_broadcast, pieces, shared_ids, shingles, stage, text_or_empty, text_pieces, word_hashes,
)

#: Lists of more classes than this do not give pairs but a star.
LIST = 48
#: Classes searched together in memory at most (two blocks of half of it, if a group is larger).
BLOCK = 2048
#: Bits of a shingle's hash that address the bitmap of frequent shingles (8 MB).
BITMAP = 26
#: Shingles that one range of the count holds on average.
COUNTED = 2_000_000
#: Shingles that a task sorts before it deals them to the ranges.
DEALT = 1_000_000
#: Postings that one range holds on average.
RANGE = 400_000
#: Pairs of classes that are added up at a time.
PAIRS = 500_000
#: Long lists that are probed for the candidates at a time.
PROBED = 64


def threshold(size, percent: int):
    """Least overlap with any set: a union is no smaller than the larger of the two sets."""
    return -(-size * percent // 100)


def merge_bound(size: int, percent: int) -> int:
    return min(3, int(threshold(size, percent)))


def _edges(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1])))


def divide_skip(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected (a spanning forest), found by T-occurrence search.

    ``sets`` are sorted arrays of distinct shingles. A query looks for sets before it in the
    order of size. Its lists are sorted by length; all but T - k are merged, the sorted runs by
    a stable sort, and the long ones are probed by binary search for the candidates that are
    left and not yet connected to the query.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    if not len(sizes) or not sizes[-1]:
        return []
    everything = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(order)), sizes)
    _, token = np.unique(everything, return_inverse=True)
    filed = np.argsort(token, kind="stable")
    lists = owner[filed]  # ascending within a list
    place = np.empty_like(filed)  # of each entry in the lists
    place[filed] = np.arange(len(filed))
    keys = token[filed] * len(order) + lists
    ends = np.cumsum(sizes)
    forest, found = Forest(len(order)), []
    for q in range(len(order)):
        size = int(sizes[q])
        need = int(threshold(size, percent))
        first = int(np.searchsorted(sizes, need))  # smaller sets cannot reach the overlap
        if not size or first >= q:
            continue
        mine = slice(ends[q] - size, ends[q])
        high = place[mine]
        low = np.searchsorted(keys, token[mine] * len(order) + first)
        length = high - low
        skipped = need - merge_bound(size, percent)
        by_length = np.argsort(length, kind="stable")
        short, long = by_length[: size - skipped], by_length[size - skipped :]
        short, long = short[length[short] > 0], long[length[long] > 0][::-1]
        if not len(short):
            continue
        runs = np.concatenate([lists[low[t] : high[t]] for t in short])
        runs.sort(kind="stable")
        candidates, counts = np.unique(runs, return_counts=True)
        enough = counts >= need - skipped
        candidates, counts = candidates[enough], counts[enough]
        root = forest.root(q)
        new = np.array([forest.root(int(c)) != root for c in candidates], bool)
        candidates, counts = candidates[new], counts[new]
        for done in range(0, len(long), PROBED):
            can = counts + (len(long) - done) >= need
            candidates, counts = candidates[can], counts[can]
            if not len(candidates):
                break
            wanted = (token[mine][long[done : done + PROBED]] * len(order))[:, None] + candidates
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            counts = counts + (keys[at] == wanted).sum(axis=0)
        linked = 100 * counts >= percent * (size + sizes[candidates] - counts)
        for c in candidates[linked]:
            if forest.union(q, int(c)):
                found.append((order[q], order[int(c)]))
    return found


def _frequent(documents: DataFrame, n: int) -> np.ndarray:
    """Bitmap of the shingles that are in more than ``LIST`` documents."""
    total = documents.agg(F.sum(F.length(text_or_empty()))).first()[0] or 0
    bits = min(18, max(4, math.ceil(math.log2(total / 6 / COUNTED + 1))))  # a word takes some six characters
    top, low = np.uint64(64 - bits), np.uint64(32 - bits)

    def sorted_out(found):
        values = np.concatenate(found)
        values.sort()
        # Equal ones go on as one with a count; from LIST + 1 on the number no longer matters.
        first = _edges(values)
        seen = np.minimum(np.diff(np.append(first, len(values))), LIST + 1).astype(np.uint8)
        values = values[first]
        cuts = np.searchsorted(values >> top, np.arange(2**bits + 1, dtype=np.uint64))
        short = (values >> low).astype(np.uint32)  # the 32 bits that follow the range
        used = np.flatnonzero(np.diff(cuts))
        return pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array([x[cuts[k] : cuts[k + 1]].tobytes() for k in used], pa.binary()) for x in (short, seen))],
            names=["part", "h", "seen"])

    def deal(batches):
        found, held = [], 0
        for _, texts in text_pieces(batches):
            found.append(shingles(*word_hashes(texts), n)[0])
            held += len(found[-1])
            if held > DEALT:
                yield sorted_out(found)
                found, held = [], 0
        if held:
            yield sorted_out(found)

    def count(table: pa.Table) -> pa.Table:
        # The count takes the low byte, so that one sort in place orders both.
        values = np.concatenate([np.frombuffer(x, np.uint32).astype(np.uint64) for x in table["h"].to_pylist()])
        values <<= np.uint64(8)
        values |= np.concatenate([np.frombuffer(x, np.uint8) for x in table["seen"].to_pylist()])
        values.sort()
        seen = (values & np.uint64(255)).astype(np.uint8)
        values = (values >> np.uint64(8)).astype(np.uint32)
        edges = _edges(values)
        often = values[edges[np.add.reduceat(seen, edges, dtype=np.int64) > LIST]]
        marked = np.zeros(2 ** (BITMAP - bits), bool)
        marked[often >> np.uint32(32 - (BITMAP - bits))] = True
        return pa.table({"part": table["part"][:1], "bits": pa.array([np.packbits(marked, bitorder="little").tobytes()], pa.binary())})

    parts = documents.select("text").mapInArrow(deal, "part int, h binary, seen binary").groupBy("part").applyInArrow(count, "part int, bits binary")
    bitmap = np.zeros((2**bits, 2 ** (BITMAP - bits) // 8), np.uint8)
    for row in parts.collect():  # one slice per range, 8 MB together at any size of the corpus
        bitmap[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return bitmap.ravel()


def _is_frequent(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values >> np.uint64(64 - BITMAP)
    return bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1) == 1


def _classes(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, set size, two signatures of the set, and the shingles of the short part."""
    sent = documents.sparkSession.sparkContext.broadcast(_frequent(documents, n))
    schema = documents.select("doc_id").schema.add("size", "long").add("s1", "long").add("s2", "long").add("short", "binary")

    def run(batches):
        frequent = sent.value
        for batch, texts in text_pieces(batches):
            own, begins = shingles(*word_hashes(texts), n)
            sizes = np.diff(begins)
            some = sizes > 0
            first, second = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            first[some] = np.bitwise_xor.reduceat(own * (own >> np.uint64(7) | np.uint64(1)), begins[:-1][some])
            second[some] = np.add.reduceat(own ^ (own >> np.uint64(13)), begins[:-1][some])
            # Place of each shingle in its text's order: the frequent ones behind the others.
            last = _is_frequent(frequent, own)
            lasts = np.concatenate(([0], np.cumsum(last)))
            before = lasts[:-1] - np.repeat(lasts[begins[:-1]], sizes)
            others = np.repeat(sizes - np.diff(lasts[begins]), sizes)
            place = np.where(last, others + before, np.arange(len(own)) - np.repeat(begins[:-1], sizes) - before)
            least = threshold(sizes, percent)
            short = place < np.repeat(sizes - least + np.minimum(least, 3), sizes)
            kept = np.concatenate(([0], np.cumsum(short)))[begins]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                 binaries(own[short], kept)],
                names=schema.names)

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _related(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that may link, or that a long list connects: (a, b)."""
    total = classes.agg(F.sum(F.length("short") / 8)).first()[0] or 0
    ranges = 1 << max(4, math.ceil(math.log2(max(total, 1) / RANGE + 1)))
    shift = np.uint64(64 - int(math.log2(ranges)))

    def deal(batches):
        for batch in pieces(batches, 8192):
            lists = [np.frombuffer(x, np.uint64) for x in batch["short"].to_pylist()]
            lengths = [len(x) for x in lists]
            values = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
            owner = np.repeat(np.array(batch["rep"].to_pylist(), np.int64), lengths)
            size = np.repeat(np.array(batch["size"].to_pylist(), np.int64), lengths)
            order = np.argsort(values)
            values, owner, size = values[order], owner[order], size[order]
            cuts = np.searchsorted(values >> shift, np.arange(ranges + 1, dtype=np.uint64))
            used = [k for k in range(ranges) if cuts[k] < cuts[k + 1]]
            packed = [[x[cuts[k] : cuts[k + 1]].tobytes() for k in used] for x in (values, owner, size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), *(pa.array(x, pa.binary()) for x in packed)], names=["part", "h", "rep", "size"])

    def added_up(rows: np.ndarray) -> np.ndarray:
        """One row per pair; no bound is above 3, so counts may stop there."""
        if not len(rows):
            return rows
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        firsts = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1))))
        return np.column_stack([rows[firsts, :2], np.minimum(np.add.reduceat(rows[:, 2], firsts), 3), rows[firsts, 3]])

    def pairs(table: pa.Table) -> pa.Table:
        values, owner, size = (
            np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])
            for name, kind in (("h", np.uint64), ("rep", np.int64), ("size", np.int64)))
        order = np.lexsort((owner, values))
        values, owner, size = values[order], owner[order], size[order]
        edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
        lengths = np.diff(edges)
        starts, lengths = edges[:-1][lengths > 1], lengths[lengths > 1]
        out = [np.zeros((0, 4), np.int64)]
        for length in np.unique(lengths[lengths <= LIST]):
            i, j = np.triu_indices(length, 1)
            of_length = starts[lengths == length]
            for done in range(0, len(of_length), max(1, PAIRS // len(i))):
                at = of_length[done : done + max(1, PAIRS // len(i)), None] + np.arange(length)
                a, b = at[:, i].ravel(), at[:, j].ravel()
                small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
                fits = small >= threshold(large, percent)
                a, b = a[fits], b[fits]
                bound = np.minimum(3, threshold(np.minimum(size[a], size[b]), percent))
                out.append(added_up(np.column_stack([owner[a], owner[b], np.ones(len(a), np.int64), bound])))
        for start, length in zip(starts[lengths > LIST], lengths[lengths > LIST], strict=True):
            rest = owner[start + 1 : start + length]
            out.append(np.column_stack([np.full(len(rest), owner[start]), rest, np.full(len(rest), 3), np.full(len(rest), 3)]))
        rows = added_up(np.concatenate(out))
        return pa.table({name: pa.array(rows[:, k], pa.int64()) for k, name in enumerate(("a", "b", "n", "bound"))})

    dealt = classes.select("rep", "size", "short").mapInArrow(deal, "part int, h binary, rep binary, size binary")
    found = dealt.groupBy("part").applyInArrow(pairs, "a long, b long, n long, bound long")
    found = found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("bound").alias("bound"))
    return found.where("n >= bound").select("a", "b")


def _links(documents: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """Exact links inside the groups (node, component): a spanning forest as (a, b)."""
    members = groups.withColumn("members", F.lit(1)).groupBy("component").agg(F.sum("members").alias("members"))
    groups = stage(groups.join(members, "component"), "ngram-groups")
    total = groups.count()
    tasks = max(1, math.ceil(2 * total / BLOCK))
    half = BLOCK // 2
    wanted = groups.select(F.col("node").alias("doc_id"), "component", "members")
    rows = documents.select("doc_id", "text").join(limited_broadcast(wanted, total), "doc_id")
    schema = "component long, members long, doc_id long, own binary"

    def run(batches):
        for batch, texts in text_pieces(batches):
            yield pa.RecordBatch.from_arrays(
                [batch["component"], batch["members"], batch["doc_id"].cast(pa.int64()), binaries(*shingles(*word_hashes(texts), n))],
                names=["component", "members", "doc_id", "own"])

    sets = rows.mapInArrow(run, schema).where("length(own) > 0")
    blocks = F.ceil(F.col("members") / half).cast("int")
    block = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    whole = F.array(F.struct(F.pmod(F.xxhash64("component"), F.lit(tasks)).alias("x"), F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    cut = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda k: F.struct(F.col("component").alias("x"), F.least(k, block).alias("i"), F.greatest(k, block).alias("j")))
    # A group that fits goes to one task with others; else its blocks meet pair by pair.
    dealt = sets.withColumn("at", F.explode(F.when(F.col("members") <= BLOCK, whole).otherwise(cut)))

    def search(table: pa.Table) -> pa.Table:
        ids = np.array(table["doc_id"].to_pylist(), np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in table["own"].to_pylist()]
        found = divide_skip(sets, percent)
        return pa.table({"a": pa.array([int(ids[i]) for i, _ in found], pa.int64()), "b": pa.array([int(ids[j]) for _, j in found], pa.int64())})

    return dealt.select("at.*", "doc_id", "own").groupBy("x", "i", "j").applyInArrow(search, "a long, b long")


def join(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest reachable doc_id)."""
    sets = stage(_classes(documents, n, percent), "ngram-sets")
    key = ["size", "s1", "s2"]
    classes = sets.where("size > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(
        F.min("doc_id").cast("long").alias("rep"), F.first("short").alias("short"))
    classes = stage(classes, "ngram-classes")
    groups = connected_components(_related(classes, percent), "ngram-related")
    linked = connected_components(_links(documents, groups, n, percent), "ngram-links")
    # A doc_id on rows with different texts connects their classes.
    shared = sets.where("size > 0 AND doc_id IS NOT NULL").select("doc_id", *key).join(classes.drop("short"), key)
    twice = shared_ids(shared.select(F.col("doc_id").alias("id"), "rep"), "ngram-shared")
    if not twice.isEmpty():
        linked = connected_components(
            linked.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(twice), "ngram-links")
    named = classes.drop("short").join(linked, F.col("rep") == F.col("node"), "left")
    named = named.select(*key, F.coalesce("component", "rep").alias("component"))
    return (
        sets.drop("short").join(named, key, "left")
        .select("doc_id", F.col("size").alias("n_shingles"),
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).cast("long").alias("component_id")))


def keep_one(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that a document of smaller id is connected to; of rows that
    share the kept id, one stays. Rows without id stay."""
    kept = join(documents, n, percent).where("doc_id = component_id").select("doc_id").distinct()
    kept = stage(kept, "ngram-kept")
    rows = documents.join(limited_broadcast(kept, kept.count()), "doc_id", "left_semi")
    repeated = stage(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "ngram-repeated")
    if not repeated.isEmpty():
        single = rows.join(repeated, "doc_id", "left_anti")
        several = rows.join(repeated, "doc_id", "left_semi")
        first = several.groupBy("doc_id").agg(F.min(F.struct(*(c for c in documents.columns if c != "doc_id"))).alias("r"))
        rows = single.unionByName(first.select("doc_id", "r.*"))
    return rows.unionByName(documents.where("doc_id IS NULL")).select(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: 4-word shingles, Jaccard of at least 0.85."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85)


#: All pairs through the shingles they share, for tables whose ids are present and distinct.
ORACLE = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM worded WHERE len(w) > 0)
), sized AS (
  SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN shingled s ON s.doc_id = d.doc_id GROUP BY d.doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), linked AS (
  SELECT m.a, m.b FROM met m JOIN sized x ON x.doc_id = m.a JOIN sized y ON y.doc_id = m.b
  WHERE 100 * m.n >= 85 * (x.n + y.n - m.n)
), edges AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reached AS (
  SELECT doc_id, doc_id AS other FROM sized UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id
FROM sized s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""
