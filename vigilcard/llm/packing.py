"""Conflict-constrained best-fit packing of documents into sequences of fixed length.

Documents are cut into pieces of at most ``capacity`` words; a whole-capacity piece is a bin of
its own. The rest go, largest first, to the bin with the least residual that holds them and
does not conflict. Bins are kept by residual; a bit set of the residuals in use gives the
successor of a size, and the search goes on from successor to successor until a compatible bin
is found, or opens a new bin. Each bin carries a bitmap of the duplicate clusters in it and one
bitmap per allowed repeat of a source: no bin holds two pieces of one cluster, nor more than
``per_source`` pieces of one source (0: no limit).

Pieces are dealt to shards of about ``shard`` rows by a hash of their row number, independent
of id, source and cluster, so that a hot one is spread evenly; every shard is packed on its
own, which also bounds how many conflicting bins a search can pass. Row numbers follow the
table's files: the same files give the same bins.

Defined cases: a null or empty text has no pieces and one row without bin; a null source is a
source; equal texts (by hash) are a cluster, and so are rows of one value in the cluster column or
in ``clusters`` (null or missing: of the text's alone), and pieces of one document; repeated rows
are documents each; a null doc_id is allowed, and the query knows such a row by its text only; an
empty table gives an empty result; ``pack`` ignores other columns.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm import ngram_join
from vigilcard.llm.common import stage, text_or_empty, word_count

CAPACITY, PER_SOURCE, SHARD = 4096, 8, 3000


class Bins:
    """Open bins by residual. The clusters of a piece come as a bitmap."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used = 0  # bit r is set if a bin has residual r
        self.residual: list[int] = []
        self.clusters: list[int] = []  # bitmap of the clusters in a bin
        self.sources: list[list[int]] = []  # bitmaps of sources seen once, twice, ...

    def compatible(self, b: int, cluster: int, source: int) -> bool:
        full = self.per_source and self.sources[b][-1] >> source & 1
        return not (full or self.clusters[b] & cluster)

    def find(self, size: int, cluster: int, source: int) -> int | None:
        """The compatible bin of least residual that holds ``size``; the earliest of equals."""
        above = self.used >> size
        residual = size
        while above:
            step = (above & -above).bit_length() - 1  # successor among residuals in use
            residual += step
            for b in self.at[residual]:
                if self.compatible(b, cluster, source):
                    return b
            above >>= step + 1
            residual += 1
        return None

    def add(self, size: int, cluster: int, source: int) -> tuple[int, int]:
        """Places a piece; its bin and the words before it there."""
        b = self.find(size, cluster, source)
        if b is None:
            b = len(self.residual)
            self.residual.append(self.capacity)
            self.clusters.append(0)
            self.sources.append([0] * max(self.per_source, 1))
        else:
            left = self.at[self.residual[b]]
            left.remove(b)
            if not left:
                self.used &= ~(1 << self.residual[b])
        start = self.capacity - self.residual[b]
        self.residual[b] -= size
        self.clusters[b] |= cluster
        carry = 1 << source
        for k, seen in enumerate(self.sources[b]):
            self.sources[b][k], carry = seen | carry, seen & carry
        if self.residual[b]:
            self.at[self.residual[b]].append(b)
            self.used |= 1 << self.residual[b]
        return b, start


def pack_pieces(rows: list[tuple], capacity: int, per_source: int) -> list[tuple]:
    """Best-fit decreasing of (size, cluster, source, ...) rows: (bin, start) in row order. A tuple
    as cluster names several."""
    order = sorted(range(len(rows)), key=lambda k: (-rows[k][0], k))
    clusters: dict = {}
    sources: dict = {}
    bins, out = Bins(capacity, per_source), [(0, 0)] * len(rows)
    for k in order:
        size, cluster, source = rows[k][:3]
        mask = 0
        for one in cluster if isinstance(cluster, tuple) else (cluster,):
            mask |= 1 << clusters.setdefault(one, len(clusters))
        out[k] = bins.add(size, mask, sources.setdefault(source, len(sources)))
    return out


def pieces_of(documents: DataFrame, capacity: int, cluster: str | None) -> DataFrame:
    """A narrow row per piece: doc_id, source, same (hash of the text), cluster, piece, row (a hash of its
    place in the table), from_word, n_words (0 for a document without words)."""
    text = text_or_empty()
    group = F.lit(None) if cluster is None else F.when(F.col(cluster).isNotNull(), F.xxhash64(cluster))
    rows = documents.select("doc_id", "source", F.xxhash64(text).alias("same"), group.cast("long").alias("cluster"), word_count(text).alias("words"))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0)).cast("int"))))
    begin = F.col("piece").cast("long") * capacity
    row = F.xxhash64(F.monotonically_increasing_id())
    return rows.select("doc_id", "source", "same", "cluster", "piece", row.alias("row"), begin.alias("from_word"), F.least(F.col("words") - begin, F.lit(capacity)).alias("n_words"))


def pack(documents: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD, cluster: str | None = None,
         clusters: DataFrame | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, from_word, n_words, bin (shard and number, null without
    words), bin_start (words before it in the bin). ``cluster`` is a column of the documents,
    ``clusters`` a table of doc_id (each once) and cluster in its place."""
    rows = stage(pieces_of(documents, capacity, cluster), "packing-pieces")
    full = rows.where(F.col("n_words").isin(0, capacity))
    rest = rows.where(~F.col("n_words").isin(0, capacity))
    shards = max(1, math.ceil(rest.count() / shard))
    if clusters is not None:
        rest = rest.drop("cluster").join(clusters.select("doc_id", F.xxhash64("cluster").alias("cluster")), "doc_id", "left")
    dealt = F.pmod("row", F.lit(shards)).cast("int")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "row")])
        size, same, group, source = (table[c].to_pylist() for c in ("n_words", "same", "cluster", "source"))
        keys = [(("same", x),) if y is None else (("same", x), ("cluster", y)) for x, y in zip(same, group, strict=True)]
        found = pack_pieces(list(zip(size, keys, source, strict=True)), capacity, per_source)
        number = table["shard"][0].as_py()
        return pa.table({
            **{c: table[c] for c in ("doc_id", "piece", "from_word", "n_words")},
            "bin": pa.array([f"{number}-{b}" for b, _ in found], pa.string()), "bin_start": pa.array([s for _, s in found], pa.int64())})

    narrow = ["doc_id", "piece", "from_word", "n_words"]
    schema = rows.select(*narrow).schema.add("bin", "string").add("bin_start", "long")
    packed = rest.withColumn("shard", dealt).groupBy("shard").applyInArrow(run, schema)
    own = F.when(F.col("n_words") > 0, F.concat(F.lit("full-"), F.hex("row")))
    alone = full.select(*narrow, own.alias("bin"), F.when(F.col("n_words") > 0, F.lit(0)).cast("long").alias("bin_start"))
    return packed.unionByName(alone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all documents in bins of 4096 words, near duplicates (components of five-word shingles,
    Jaccard 0.8) never together, at most eight pieces of a source in a bin."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = ngram_join.join(documents, 5, 80).where("doc_id IS NOT NULL AND n_shingles > 0")
    found = found.groupBy("doc_id").agg(F.min("component_id").alias("cluster"))
    return pack(documents, clusters=found)
