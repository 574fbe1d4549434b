"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.sources.scratch import scratch_path

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one side that a hint may broadcast; the rows are counted first.
BROADCAST_ROWS = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared checkpoint folder and returns the stored one.

    It cuts lineage and outlives executors. The caller's folder is temporary by contract: what
    is staged there stays until the folder is cleared.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def id_fold(folds: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes; ``bytes.split`` cuts at ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FIRST_BYTES = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)
#: Words longer than this are hashed one by one.
_LONG_WORD = 256


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (A-Z as a-z), one after the other, and where the
    words of each text begin (one entry more than texts).

    Words are read eight bytes at a time; equal hashes of words up to eight bytes are equal words
    of their length.
    """
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    joined = b"".join((b"\n", b"\n".join(t or b"" for t in texts).lower(), b"\n" * 9))
    space = _SPACE[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, size = edges[0::2], edges[1::2] - edges[0::2]
    found = span_hashes(joined, start, size)
    begins = np.concatenate(([1], 1 + np.cumsum(lengths + 1)))
    return found, np.searchsorted(start, begins)


def span_hashes(joined: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words that begin at ``start``, eight bytes at a time; behind the last
    one ``joined`` goes on for seven bytes at least."""
    eight = np.ndarray((len(joined) - 7,), np.dtype("<u8"), joined, strides=(1,))
    found = _spread(eight[start] & _FIRST_BYTES[np.minimum(size, 8)] ^ size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rest, done = np.flatnonzero((size > 8) & (size <= _LONG_WORD)), 8
    while len(rest):
        part = eight[start[rest] + done] & _FIRST_BYTES[np.minimum(size[rest] - done, 8)]
        found[rest] = _spread(found[rest] * np.uint64(0xC2B2AE3D27D4EB4F) + part)
        done += 8
        rest = rest[size[rest] > done]
    for k in np.flatnonzero(size > _LONG_WORD):
        found[k] = xxhash.xxh3_64_intdigest(joined[start[k] : start[k] + size[k]])
    return found


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def shingles(hashes: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text (with fewer words, one of all
    words), one text after the other, and where those of each text begin.

    ``hashes`` and ``begins`` are what ``word_hashes`` gives.
    """
    words = np.diff(begins)
    counts = np.maximum(words - n + 1, np.minimum(words, 1))
    out = np.empty(counts.sum(), np.uint64)
    at = np.concatenate(([0], np.cumsum(counts)))
    whole = max(0, len(hashes) - n + 1)
    inside = np.arange(whole) + n <= np.repeat(begins[1:], words)[:whole]
    out[np.repeat(words >= n, counts)] = _rolled(hashes, n)[inside]
    for k in np.flatnonzero((words > 0) & (words < n)):
        out[at[k]] = _rolled(hashes[begins[k] : begins[k + 1]], int(words[k]))[0]
    for first, last in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        out[first:last].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[at[:-1][counts > 0]] = True
    return out[new], np.concatenate(([0], np.cumsum(new)))[at]


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    count = max(0, len(hashes) - width + 1)
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : k + count]
    return mix(total)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small, so that Python holds few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_pieces(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Arrow batches cut where their column ``text`` passes ``size`` bytes, and the texts as UTF-8.
    A longer text is a piece of its own."""
    for batch in batches:
        text = batch["text"].cast(pa.large_binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start), text.slice(start, stop - start).to_pylist()
            start = stop


def binaries(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between each of ``begins`` and the next, as Arrow values."""
    offsets = pa.py_buffer((begins * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


class Forest:
    """Union-find over 0..n-1; a root is the smallest member."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def limited_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a side whose counted rows are few; else Spark chooses the join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shared_ids(rows: DataFrame, name: str) -> DataFrame:
    """Edges (a, b) between the classes that rows of one id are in, from rows (id, rep): each rep
    of an id with the least of them, whether or not the id is a rep itself."""
    several = rows.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b < most").drop("most")
    several = stage(several, name)
    if several.isEmpty():
        return several.select(F.col("b").alias("a"), "b")
    return rows.join(several, "id").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable id of each node that has an edge: (node, component).

    ``edges`` has long columns ``a`` and ``b``. Large-star and small-star rounds: every round
    points nodes at the smallest neighbour, so the number of edges never grows and the number
    of rounds is logarithmic. A round is written to the checkpoint folder; the driver sees a
    count and a checksum only.
    """

    def state(df: DataFrame) -> tuple:
        check = F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(2**31)))
        return tuple(df.agg(F.count("*"), check).first())

    def both(df: DataFrame) -> DataFrame:
        return df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))

    now = edges.where("a <> b").select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    now = stage(now.distinct(), name)
    before, current = None, state(now)
    while before != current:
        ends = both(now)
        least = ends.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = ends.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        now = stage(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), name)
        before, current = current, state(now)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
