"""Mixing sources to target weights by a low-discrepancy schedule.

Targets. Sources in the order of their names take their weights in turn; the mix is ``share``
times all words, dealt by weight, and no source gives more than ``epochs`` times its words: what
lies above is dealt again by weight until nothing does. With sources in the order of
(limit / weight) those at their limit come first, so one pass of running sums finds the level.

Schedule. The mix is a row of slots of equal word counts. A source gets its target, rounded to
whole words, in as many slots as that takes; its last slot may be partial. All slots share out n
places, a source's side by side, and slot k takes place k * step mod n: a rank-1 lattice, whose
step is looked for near n / golden ratio such that its ratio to n has small partial quotients
alone (as the golden ratio has). So every stretch of slots has nearly the target shares, at any
n, and each source gets exactly its slots. The j-th slot of a source takes block j of its stream:
its documents in a hashed order, word after word, again and again. Slots and pieces of documents
meet in a join on (source, block).

Ranks and positions are running counts within chunks of slots and within ranges of the hash of a
source's documents, as many as the documents ask for, plus running sums over both, so that a
source with a third of all rows is spread over many tasks. A rerun gives the same schedule.

Defined cases: a null or empty text has size 0 and nothing taken; a null source is one of its
own, last; null doc_ids and repeated rows are rows like others; an empty table gives an empty
result; other columns are ignored, and kept by ``apply``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilcard.llm.common import stage, text_or_empty, word_count

#: Words of a slot at most, and the slots that a small mix is cut into.
SLOT_WORDS, SLOTS = 1024, 2**18
#: Places that one source's cell and one chunk of slots hold, and documents of a range of the hash.
CELLS, CHUNK, RANGE = 1024, 2**14, 50_000
HASH_BITS = 31
_PRIME = 2**31 - 1


def hashed(column: Column) -> Column:
    """A 31-bit hash of an integer, in arithmetic that every SQL engine has."""
    h = (F.pmod(F.coalesce(column.cast("long"), F.lit(0)), F.lit(_PRIME)) * 48_271 + 11) % _PRIME
    h = (h.bitwiseXOR(F.shiftright(h, 15)) * 69_621) % _PRIME
    return h.bitwiseXOR(F.shiftright(h, 13))


def sizes(documents: DataFrame) -> DataFrame:
    """The narrow rows that are mixed: doc_id, source, size."""
    return documents.select("doc_id", "source", word_count(text_or_empty()).alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """One row per source: source, sid (its rank), source_size, target, goal (the target in whole
    words), total (of all targets)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("sid", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.array(*map(F.lit, weights))[F.col("sid") % len(weights)])
    rows = rows.withColumn("most", F.col("source_size") * epochs)
    ahead = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    full = ahead.rowsBetween(Window.unboundedPreceding, -1)
    rest = ahead.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn("level", (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(full), F.lit(0))
    ) / F.sum("weight").over(rest))
    rows = rows.withColumn("open", F.col("most") / F.col("weight") > F.col("level"))
    level = F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.struct(F.col("most") / F.col("weight"), F.col("sid"))))
    rows = rows.withColumn("level", level.over(everything))
    most = F.col("most").cast("double")
    rows = rows.withColumn("target", F.least(most, F.coalesce(F.col("weight") * F.col("level"), most)))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    return rows.select("source", "sid", "source_size", "target", goal.alias("goal"), F.sum("target").over(everything).alias("total"))


def slot_words(total: float) -> int:
    return max(1, min(SLOT_WORDS, math.floor(total / SLOTS)))


def lattice_step(n: int) -> int:
    """A step prime to n whose ratio to n has the least greatest partial quotient among the 4,096
    steps next to n / golden ratio; n times the step has to fit a long."""
    def greatest(step: int) -> int:
        a, b, most = n, step, 0
        while b:
            a, b, most = b, a % b, max(most, a // b)
        return most if a == 1 else n

    if n < 3:
        return 1
    middle = round(n * (math.sqrt(5) - 1) / 2)
    return min(range(max(1, middle - 2048), min(n, middle + 2048)), key=lambda step: (greatest(step), abs(step - middle)))


def shared_out(goals: DataFrame, words: int) -> DataFrame:
    """The places of each source among all: sid, lower, upper."""
    rows = goals.withColumn("count", F.ceil(F.col("goal") / words).cast("long"))
    upper = F.sum("count").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("upper", upper).select("sid", (F.col("upper") - F.col("count")).alias("lower"), "upper")


def slots(spark: SparkSession, goals: DataFrame, total: float) -> DataFrame:
    """The schedule of sources: slot, sid, block (rank of the slot in its source)."""
    places = shared_out(goals, slot_words(total))
    count = places.agg(F.max("upper")).first()[0] or 0
    step, shift = lattice_step(count), max(0, math.ceil(math.log2(max(1, count) / CELLS)))
    parts = places.where("upper > lower").select("sid", "lower", "upper", F.explode(F.sequence(
        F.shiftright("lower", shift), F.shiftright(F.col("upper") - 1, shift))).alias("cell"))
    points = spark.range(count).select(F.col("id").alias("slot"), (F.col("id") * step % max(1, count)).alias("point"))
    points = points.withColumn("cell", F.shiftright("point", shift))
    found = points.join(parts, "cell").where("point >= lower AND point < upper").select(
        "slot", "sid", (F.col("slot") / CHUNK).cast("long").alias("chunk"))
    ranked = found.withColumn("block", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = found.groupBy("sid", "chunk").count().select(
        "sid", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    return ranked.join(chunks, ["sid", "chunk"]).select("slot", "sid", (F.col("block") + F.col("base")).alias("block"))


def streams(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Documents with their place in their source's stream: start, and (sid, bucket, place)."""
    rows = sized.join(goals.select("source", "sid", "source_size", "goal"), F.equal_null(sized["source"], goals["source"])).drop(goals["source"])
    rows = rows.withColumn("h", hashed(F.col("doc_id")))
    bits = min(HASH_BITS, max(0, math.ceil(math.log2(max(1, sized.count()) / RANGE))))
    rows = rows.withColumn("bucket", F.shiftright("h", HASH_BITS - bits))
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size")
    rows = rows.withColumn("place", F.row_number().over(inside))
    rows = rows.withColumn("start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n")).select(
        "sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(buckets, ["sid", "bucket"]).withColumn("start", F.col("start") + F.col("base")).drop("base", "h")


def schedule(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> tuple[DataFrame, DataFrame]:
    """The targets and the pieces: a row for each document, epoch and block that it reaches into
    (one without block for a document of size 0): slot (null if the block is not taken),
    from_word and n_words within the document, and the document's columns of ``streams``."""
    spark = documents.sparkSession
    sized = stage(sizes(documents), "mix-sizes")
    goals = stage(targets(sized, weights, share, epochs), "mix-targets")
    total = goals.agg(F.max("total")).first()[0] or 0.0
    words = slot_words(total)
    rows = streams(sized, goals).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    block = lambda word: F.floor(word / words)
    rows = rows.withColumn("begin", begin).withColumn("block", F.explode_outer(
        F.when(F.col("size") > 0, F.sequence(block(F.col("begin")), block(F.col("begin") + F.col("size") - 1)))))
    first = F.greatest(F.col("begin"), F.col("block") * words)
    last = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * words, "goal")
    rows = rows.withColumn("from_word", first - F.col("begin")).withColumn("n_words", F.greatest(last - first, F.lit(0)))
    rows = rows.drop("begin", "goal")
    return goals, rows.join(slots(spark, goals, total), ["sid", "block"], "left")


def taken(documents: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and the words of
    each epoch (``by_epoch``)."""
    goals, found = schedule(documents, **options)
    epochs = options.get("epochs", 2)
    of = lambda e: F.coalesce(F.sum(F.when(F.col("slot").isNotNull() & (F.col("epoch") == e), F.col("n_words"))), F.lit(0))
    rows = found.groupBy("sid", "bucket", "place", "doc_id", "size").agg(*(of(e).alias(f"epoch{e}") for e in range(epochs)))
    each = F.array(*(F.col(f"epoch{e}") for e in range(epochs)))
    return rows.join(goals.select("sid", "source", "source_size", "target"), "sid").select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"), each.alias("by_epoch"))


def apply(documents: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them, a row for each epoch with words taken: whole texts as
    they are, and of a document that the mix ends in, its first words taken, with single spaces
    (one per source at most). Columns are those of the documents."""
    same = ["doc_id", "source", "size"]
    each = Window.partitionBy(*same)
    mixed = taken(documents, **options).where("taken > 0").select(*same, "by_epoch")
    mixed = mixed.withColumn("nth", F.row_number().over(each.orderBy(F.desc("by_epoch"))))
    rows = documents.select(
        "doc_id", "source", word_count(text_or_empty()).alias("size"), F.struct(*documents.columns).alias("row"))
    rows = rows.withColumn("nth", F.row_number().over(each.orderBy("row.text")))
    on = [F.equal_null(rows[c], mixed[c]) for c in [*same, "nth"]]
    kept = rows.join(mixed, on).select("row", rows["size"], F.explode("by_epoch").alias("n")).where("n > 0")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(r"[^\x20\x09-\x0D]+"), 0)
    text = F.when(F.col("n") < F.col("size"), F.array_join(F.slice(words, 1, F.col("n").cast("int")), " ")).otherwise(F.col("row.text"))
    return kept.withColumn("row", F.col("row").withField("text", text)).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents, weights 5, 2, 1, repeating, 150 % of all words, two epochs at most."""
    rows = taken(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


#: The same in closed form: a source's slots cover the beginning of its stream up to its target.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sized GROUP BY source
), weighted AS (
  SELECT *, 2 * source_size AS most, [5, 2, 1][(sid % 3) + 1] AS weight, sum(source_size) OVER ()::BIGINT AS words FROM per_source
), levels AS (
  SELECT *, (words * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
            / sum(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS level FROM weighted
), targets AS (
  SELECT *, least(most::DOUBLE, coalesce(weight * (SELECT arg_min(level, most / weight) FROM levels WHERE most / weight > level), most::DOUBLE)) AS target FROM levels
), covered AS (
  SELECT sid, source, source_size, target, floor(target + 0.5)::BIGINT AS reach FROM targets
), hash1 AS (
  SELECT *, (((coalesce(doc_id, 0) % 2147483647) + 2147483647) % 2147483647 * 48271 + 11) % 2147483647 AS h1 FROM sized
), hash2 AS (
  SELECT *, (xor(h1, h1 >> 15) * 69621) % 2147483647 AS h2 FROM hash1
), placed AS (
  SELECT doc_id, size, source_size, target, reach,
         sum(size) OVER (PARTITION BY sid ORDER BY xor(h2, h2 >> 13), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM hash2 JOIN covered ON hash2.source IS NOT DISTINCT FROM covered.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(reach, start + size) - start) + greatest(0, least(reach - source_size, start + size) - start))::BIGINT AS taken
FROM placed
"""
