"""Sets of rows kept in levels: small deltas that are merged, level by level, into larger ones.

A batch adds one folder. ``FAN`` folders of a level become one of the next, so a row is rewritten
a logarithmic number of times and the number of folders stays logarithmic as well. A folder of
more than ``PLAIN`` rows is cut into buckets by a hash of the key; a look-up with few keys lists
and opens only the buckets those keys fall in.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigilcard.sources.manifest import Files, Manifest

FAN = 8
# Rows up to which a folder is one file; beyond, rows that a bucket is made for, and most buckets.
PLAIN, PER_BUCKET, MOST_BUCKETS = 50_000, 2_500, 4096
# Rows of one writing task.
PER_TASK = 1_000_000
# A look-up that touches more buckets than this reads the whole folder.
NAMED_BUCKETS = 2048


def bucket_count(rows: int) -> int:
    """A power of two, so that buckets of different folders nest."""
    return 1 if rows <= PLAIN else min(MOST_BUCKETS, 1 << math.ceil(math.log2(rows / PER_BUCKET)))


class Levels:
    """A set of distinct rows of one schema below a folder, keyed by one string column."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: str) -> None:
        self.spark, self.folder, self.schema, self.key = spark, folder, schema, key
        self._files = Files(spark)
        self._manifest = Manifest(self._files, f"{folder}/index")

    def started(self) -> bool:
        """Whether there is an index at all, be it an empty one."""
        return self._manifest.exists()

    def start(self) -> None:
        """Begins an empty index."""
        self._manifest.change(lambda entries: entries)

    def entries(self, hidden: frozenset[str] = frozenset()) -> list[dict]:
        """Folders that count, without those of hidden batches."""
        return [e for e in self._manifest.entries() if e["batch"] not in hidden and e["level"] >= 0]

    def add(self, rows: DataFrame, batch: str) -> None:
        """Adds the rows of a batch as a folder of the lowest level."""
        entry = self._written(rows, rows.count(), 0, batch)
        self._manifest.change(lambda entries: [*entries, entry])

    def forget(self, batch: str) -> None:
        """Takes back what a batch has added."""
        gone = [e for e in self._manifest.entries() if e["batch"] == batch]
        if gone:
            self._manifest.change(lambda entries: [e for e in entries if e["batch"] != batch])
        for entry in gone:
            self._files.delete(entry["folder"])

    def merge(self, hidden: frozenset[str] = frozenset()) -> None:
        """Merges every level that is full. Replaced folders are deleted one merge later, as
        readers may still use them."""
        level = 0
        while True:
            full = [e for e in self.entries(hidden) if e["level"] == level]
            if len(full) >= FAN:
                rows = self._union(full, None).distinct()
                merged = self._written(rows, sum(e["rows"] for e in full), level + 1, "merged")
                names = {e["folder"] for e in full}
                before = [e["folder"] for e in self._manifest.entries() if e["level"] < 0]
                self._manifest.change(lambda entries: [
                    *(({**e, "level": -1} if e["folder"] in names else e) for e in entries if e["folder"] not in before), merged])
                for folder in before:
                    self._files.delete(folder)
            elif not any(e["level"] > level for e in self.entries(hidden)):
                return
            level += 1

    def read(self, hidden: frozenset[str] = frozenset()) -> DataFrame:
        """All rows; a row may come more than once before a merge."""
        return self._union(self.entries(hidden), None)

    def near(self, keys: DataFrame, hidden: frozenset[str] = frozenset()) -> DataFrame:
        """The rows of the buckets that hold the given keys, a superset of their rows."""
        at = F.pmod(F.xxhash64(self.key), F.lit(MOST_BUCKETS)).cast("int").alias("at")
        hit = {r["at"] for r in keys.select(at).distinct().collect()}  # MOST_BUCKETS numbers at most
        return self._union(self.entries(hidden), hit)

    def _union(self, entries: list[dict], hit: set[int] | None) -> DataFrame:
        found = self.spark.createDataFrame([], self.schema)
        for entry in entries:
            path, buckets = entry["folder"], entry["buckets"]
            if buckets > 1 and hit is not None:
                mine = sorted({h % buckets for h in hit})
                if not mine:
                    continue
                if len(mine) <= NAMED_BUCKETS and len(mine) < buckets:
                    path = self._files.matching(f"{path}/bucket={{{','.join(map(str, mine))}}}")
            if path:
                part = self.spark.read.option("basePath", entry["folder"]).schema(self.schema).parquet(*([path] if isinstance(path, str) else path))
                found = found.unionByName(part.select(*self.schema.names))
        return found

    def _written(self, rows: DataFrame, n: int, level: int, batch: str) -> dict:
        folder, buckets = f"{self.folder}/{batch}-{uuid.uuid4().hex}", bucket_count(n)
        rows = rows.select(*self.schema.names)
        if buckets == 1:
            rows.repartition(1).sortWithinPartitions(self.key).write.parquet(folder)
        else:
            at = F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")
            tasks = min(buckets, max(8, math.ceil(n / PER_TASK)))
            dealt = rows.withColumn("bucket", at).repartition(tasks, "bucket").sortWithinPartitions("bucket", self.key)
            dealt.write.partitionBy("bucket").parquet(folder)
        return {"folder": folder, "level": level, "rows": n, "buckets": buckets, "batch": batch}
