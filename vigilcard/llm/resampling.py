"""Target-distribution importance resampling with an untrained pre-tokeniser.

Documents are drawn so that their words follow the distribution of a target table. A Regex Split
of the tokenizers library, which needs no training, cuts the ASCII-lowered text into words with
offsets. Windows over consecutive offset pairs are the features: ``least_n`` to ``most_n`` words
joined by one space, each in the bucket that the CRC of its bytes names. Both tables become
histograms of buckets; a bucket's gain is the floored log ratio of its smoothed shares, a
document's weight the sum of its features' gains. Adding Gumbel noise, fixed by seed and
doc_id, to the weight and taking the highest scores draws without replacement in proportion to
the exponential of the weights.

On Spark: each text is pre-tokenised once, in Arrow batches; its buckets are stored as an array
of small integers, from which a second pass sums the histogram and a third the weights. What is
broadcast is one number per bucket. Ranks come from a range partitioning by score: the counts
of the ranges, one row each, give every range its first rank, so no task sorts more than one range.

Defined cases: a null or empty text has no features, the weight 0 and its noise as score; only
documents of at least ``least_words`` words are drawn; a null doc_id has the noise of an empty
id and ranks after all ids among equal scores; repeated rows are documents each, with equal
scores and ranks that follow each other; an empty target leaves gains that only mirror how rare
a bucket is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from vigilcard.llm.common import documents as read_documents
from vigilcard.llm.common import pieces, stage

#: A word: ASCII digits and lower-case letters, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 2024, 10, 20
#: Rows that one range of the ranking holds on average, at most.
RANGE = 1_000_000
_CACHED = 300_000


class Buckets(dict):
    """Bucket of a feature, with a cache of bounded size."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        found = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.buckets
        if len(self) < _CACHED:
            self[feature] = found
        return found


def splitter() -> Split:
    """The untrained pre-tokeniser: what matches ``WORD`` stays, what lies between is dropped."""
    return Split(Regex(WORD), "removed", invert=True)


def spans(text: str | None, split: Split) -> tuple[str, list[tuple[int, int]]]:
    """The ASCII-lowered text and the offset pairs of its words."""
    if not text:
        return "", []
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return lowered, [at for _, at in split.pre_tokenize_str(lowered)]


def windows(lowered: str, at: list[tuple[int, int]], least_n: int, most_n: int) -> list[str]:
    """Features: every run of ``least_n`` to ``most_n`` consecutive words, joined by one space."""
    words = [lowered[a:b] for a, b in at]
    found = list(words) if least_n == 1 else []
    for n in range(max(2, least_n), most_n + 1):
        found += [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return found


def features(table: DataFrame, keep: list[str], buckets: int, least_n: int, most_n: int) -> DataFrame:
    """``keep``, n_words, n_features and the buckets of all features (32-bit integers, or 16-bit
    ones where they suffice)."""
    kind = _kind(buckets)
    schema = table.select(*keep).schema.add("n_words", "long").add("n_features", "long").add("buckets", "binary")

    def run(batches):
        split, of = splitter(), Buckets(buckets)
        for batch in pieces(batches):
            n_words, n_features, packed = [], [], []
            for text in batch["text"].to_pylist():
                lowered, at = spans(text, split)
                found = windows(lowered, at, least_n, most_n)
                n_words.append(len(at))
                n_features.append(len(found))
                packed.append(np.fromiter(map(of.__getitem__, found), kind, len(found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                 pa.array(packed, pa.binary())], names=schema.names)

    source = table.select(*keep, "text") if "text" not in keep else table.select(*keep)
    return source.mapInArrow(run, schema)


def _kind(buckets: int):
    return np.uint16 if buckets <= 2**16 else np.uint32


def histogram(stored: DataFrame, buckets: int) -> list[int]:
    """Features of a table per bucket."""
    kind = _kind(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch["buckets"]:
                total += np.bincount(np.frombuffer(found.as_py(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    counted = stored.select("buckets").where("n_features > 0").mapInArrow(run, "bucket int, n long")
    total = [0] * buckets
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        total[row["bucket"]] = row["n"]
    return total


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln(smoothed share in the target / smoothed share in the source)) per bucket."""
    size, in_source, in_target = len(source), float(sum(source)), float(sum(target))
    return [
        math.floor(1000.0 * math.log((t + 1.0) * (in_source + size) / ((s + 1.0) * (in_target + size))))
        for s, t in zip(source, target, strict=True)]


def _weighed(stored: DataFrame, keep: list[str], gain: list[int]) -> DataFrame:
    sent = stored.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))
    kind = _kind(len(gain))
    schema = stored.select(*keep).schema.add("weight", "long")

    def run(batches):
        for batch in batches:
            sums = [int(sent.value[np.frombuffer(b.as_py(), kind)].sum()) for b in batch["buckets"]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(sums, pa.int64())], names=schema.names)

    return stored.select(*keep, "buckets").mapInArrow(run, schema)


def noise(seed: int):
    """Gumbel noise in thousandths, from the first 32 bits of a hash of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _ranked(scored: DataFrame, drawn: int, rows: int) -> DataFrame:
    """``rank`` of the ``drawn`` highest scores of eligible rows; ties to smaller doc_id."""
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    configured = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(configured, math.ceil(rows / RANGE))
    dealt = scored.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id())
    dealt = stage(dealt, "resampling-ranges")
    # One row per range; ranges are as many as shuffle partitions or as millions of rows.
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("part", before.alias("before")))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = dealt.join(starts, "part").withColumn("place", place)
    return ranked.withColumn("rank", F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place")).cast("long"))


def resample(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, least_n: int = 1, most_n: int = 1,
             seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (null if not drawn).

    ``target`` has the texts whose distribution is wanted; ``percent`` of the documents with at
    least ``least_words`` words are drawn.
    """
    stored = stage(features(documents, ["doc_id"], buckets, least_n, most_n), "resampling-features")
    wanted = stage(features(target, [], buckets, least_n, most_n), "resampling-target")
    gain = gains(histogram(stored, buckets), histogram(wanted, buckets))
    scored = _weighed(stored, ["doc_id", "n_words", "n_features"], gain)
    scored = scored.select(
        "*", (F.col("weight") + noise(seed)).alias("score"), (F.col("n_words") >= least_words).alias("eligible"),
        F.monotonically_increasing_id().alias("row"))
    scored = stage(scored, "resampling-scores")
    rows, eligible = scored.agg(F.count("*"), F.count_if("eligible")).first()
    ranked = _ranked(scored, percent * eligible // 100, rows)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def drawn(documents: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn documents with all their columns; rows that share a drawn doc_id come together."""
    ids = resample(documents, target, **parameters).where("rank IS NOT NULL").select("doc_id").distinct()
    return documents.join(ids, "doc_id", "left_semi").select(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: a tenth of all documents towards the words of the benchmark."""
    found = resample(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: For tables whose ids are present and distinct. The CRC table follows from its polynomial.
ORACLE = rf"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{WORD}') AS w FROM documents
), aimed AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '{WORD}')) AS w FROM benchmark
), worded AS (
  SELECT doc_id, unnest(w) AS w FROM lowered
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
    FROM range(256) r(i))
), octets AS (
  SELECT w, list_transform(range(0, octet_length(encode(w))),
                           lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS b
  FROM (SELECT w FROM worded UNION SELECT w FROM aimed)
), placed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, b), lambda c, o: xor(c >> 8, t[(xor(c, o) & 255) + 1])), 4294967295)
            % {BUCKETS} AS bucket FROM octets, crc_table
), source AS (
  SELECT bucket, count(*) AS s FROM worded JOIN placed USING (w) GROUP BY bucket
), wanted AS (
  SELECT bucket, count(*) AS t FROM aimed JOIN placed USING (w) GROUP BY bucket
), gained AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM worded) + {BUCKETS})
           / ((s + 1)::DOUBLE * ((SELECT count(*) FROM aimed) + {BUCKETS}))))::BIGINT AS gain
  FROM source LEFT JOIN wanted USING (bucket)
), weighed AS (
  SELECT doc_id, sum(gain)::BIGINT AS weight FROM worded JOIN placed USING (w) JOIN gained USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(l.w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                / 4294967296)))::BIGINT AS score
  FROM lowered l LEFT JOIN weighed USING (doc_id)
), placed_first AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= {LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT count(*) * {PERCENT} // 100 FROM placed_first) THEN place END AS rank
FROM scored LEFT JOIN placed_first USING (doc_id)
"""
