"""Quality rules: base counts, and divergence of a text's histograms from its language.

A text has two histograms: of its characters over classes, and of its words over a fixed list
of common words of some languages and "other". The reference of a language is the sum over the
documents of that language that pass the base rules (see ``judge``). A text is rejected if the Jensen-Shannon
distance (base 2, 0 to 1) of either histogram from its reference is above a limit. Guards:
texts under ``min_words`` words are not compared. With ``languages`` None, as in the query, every
value of the lang column is a language; one whose documents have fewer than ``min_reference``
words together has no reference, and its texts and those without language are not compared. With a
list of languages, what is not in the list or has no reference is compared with all documents.

Only Spark SQL functions are used. Texts are read once; what later steps need are narrow rows
of counts. References are one row per language and, with a list, one for all.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; a null
language is an unlisted one; without a list, the value ``*`` is one like null; repeated rows count each time; ids play no role and may be null;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm.common import WORD, stage, text_or_empty

#: Frequent words of four languages.
COMMON = tuple(dict.fromkeys(
    "the of and to a in is that was for on with as it be by at from this are or an "
    "de la le et les des en un une du est que dans pour pas qui sur par au avec plus se "
    "der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch es "
    "el y los del las por con no su para al lo como".split()))
LANGUAGES = ("en", "fr", "de", "es")
#: Classes of characters in the order in which they are taken out of the text.
CLASSES = {
    "lower": "[a-z]+", "space": r"[\x20\x09-\x0D]+", "upper": "[A-Z]+", "digit": "[0-9]+",
    "mark": r"""[.,;:!?'"()\-]+""", "symbol": "[#*$%&|<>]+", "letter": r"\p{L}+",
}
WINDOW = 8
ALL = "*"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once for all its uses."""
    return F.transform(F.array(value), use)[0]


def repeated_words(hashes: Column) -> Column:
    """Words inside 8-word windows that occur twice or more, from the words' hashes."""
    def covered(windows: Column) -> Column:
        def runs(ordered: Column) -> Column:
            def twice(w: Column, k: Column) -> Column:
                return F.coalesce(F.get(ordered, k - 1)["x"] == w["x"], F.lit(False)) | F.coalesce(F.get(ordered, k + 1)["x"] == w["x"], F.lit(False))

            at = F.array_sort(F.transform(F.filter(ordered, twice), lambda w: w["at"]))
            begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
            return F.aggregate(at, begin, lambda s, i: F.struct(
                i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n")), lambda s: s["n"])

        placed = F.transform(windows, lambda x, k: F.struct(x.alias("x"), k.alias("at")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(F.sort_array(placed), runs))

    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))))
    return F.when(F.size(hashes) > WINDOW, let(windows, covered)).otherwise(0)


def measure(documents: DataFrame, languages: tuple[str, ...] | None = LANGUAGES) -> DataFrame:
    """Counts of each document: doc_id, language, the base columns, character classes and the
    common words it has with their counts."""
    listed = F.col("lang").isNotNull() if languages is None else F.col("lang").isin(*languages)
    lang = F.when(listed, F.col("lang")).otherwise(ALL)
    rows = documents.select("doc_id", lang.alias("language"), text_or_empty().alias("text"))
    rows = rows.select("*", F.regexp_extract_all("text", F.lit(WORD), 0).alias("words"), F.col("text").alias("rest"), F.length("text").alias("left"))
    counts = []
    for name, pattern in CLASSES.items():
        rows = rows.withColumn("rest", F.regexp_replace("rest", pattern, ""))
        rows = rows.withColumn("now", F.length("rest")).withColumn(f"c_{name}", F.col("left") - F.col("now")).withColumn("left", F.col("now"))
        counts.append(F.col(f"c_{name}").cast("long"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    common = F.filter(F.transform("words", F.lower), lambda w: w.isin(*COMMON))
    counted = let(common, lambda found: F.transform(
        F.array_distinct(found), lambda w: F.struct(w.alias("word"), F.size(F.filter(found, lambda x: x == w)).cast("long").alias("n"))))
    return rows.select(
        "doc_id", "language", F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.col("c_space")).cast("long").alias("word_chars"), F.col("c_symbol").cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(F.transform("words", lambda w: F.xxhash64(w)), repeated_words).cast("long").alias("n_repeat_words"),
        F.array(*counts, F.col("left").cast("long")).alias("classes"), counted.alias("common"))


def references(measured: DataFrame, min_reference: int, with_all: bool = True) -> DataFrame:
    """language, class_shares, word_shares (map): one row for each language with a reference, and
    ``*`` if all documents are one too."""
    width = len(CLASSES) + 1
    rows = measured.where(F.col("language") != ALL)
    if with_all:
        rows = measured.withColumn("language", F.explode(F.array_distinct(F.array("language", F.lit(ALL)))))
    sums = rows.groupBy("language").agg(
        F.sum("n_words").alias("words"), F.array(*(F.sum(F.col("classes")[k]) for k in range(width))).alias("sums"))
    words = rows.select("language", F.explode("common").alias("w")).groupBy("language", "w.word").agg(F.sum("w.n").alias("n"))
    words = words.groupBy("language").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("counts"))
    found = sums.join(words, "language", "left").where((F.col("words") >= min_reference) | (F.col("language") == ALL))
    total = F.aggregate("sums", F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "language", F.transform("sums", lambda x: F.when(total > 0, x / total).otherwise(0.0)).alias("class_shares"),
        F.coalesce(F.transform_values("counts", lambda _, n: n / F.col("words")), F.create_map().cast("map<string,double>")).alias("word_shares"))


def _part(p: Column, q: Column) -> Column:
    """A bin's part of the divergence, in bits."""
    def term(x: Column) -> Column:
        return F.when(x > 0, x * F.ln(2 * x / (p + q))).otherwise(0.0)

    return (term(p) + term(q)) / (2 * math.log(2))


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.least(F.greatest(divergence, F.lit(0.0)), F.lit(1.0)))


def distances(measured: DataFrame, good: DataFrame, min_words: int, min_reference: int, with_all: bool = True) -> DataFrame:
    """The measured rows with class_distance and word_distance from the references of ``good``
    (null where not compared); ``with_all``: rows without a reference are compared with all."""
    # Staged, so that Spark knows the size and broadcasts the languages only if they are few.
    given = stage(references(good, min_reference, with_all), "quality-references")
    own = given.where(F.col("language") != ALL).withColumnRenamed("language", "of")
    every = given.where(F.col("language") == ALL).select(F.col("class_shares").alias("all_classes"), F.col("word_shares").alias("all_words"))
    rows = measured.join(own, F.col("language") == F.col("of"), "left").join(F.broadcast(every), F.lit(True), "left")  # one row at most
    rows = rows.withColumn("class_shares", F.coalesce("class_shares", "all_classes")).withColumn("word_shares", F.coalesce("word_shares", "all_words"))
    compared = (F.col("n_words") >= min_words) & F.col("class_shares").isNotNull()
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    by_class = F.aggregate(
        F.zip_with("classes", "class_shares", lambda n, q: _part(n / total, q)), F.lit(0.0), lambda a, x: a + x)

    def word_divergence(shares: Column) -> Column:
        def add(s: Column, w: Column) -> Column:
            return let(F.coalesce(shares[w["word"]], F.lit(0.0)), lambda q: F.struct(
                (s["d"] + _part(w["n"] / F.col("n_words"), q)).alias("d"), (s["p"] + w["n"] / F.col("n_words")).alias("p"), (s["q"] + q).alias("q")))

        begin = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
        rest = F.aggregate(F.map_values(shares), F.lit(0.0), lambda a, x: a + x)  # of all common words
        return F.aggregate("common", begin, add, lambda s: s["d"] + F.greatest(rest - s["q"], F.lit(0.0)) / 2
                           + _part(F.greatest(1 - s["p"], F.lit(0.0)), F.greatest(1 - rest, F.lit(0.0))))

    return rows.select(
        *measured.columns, F.when(compared, _distance(by_class)).alias("class_distance"),
        F.when(compared, _distance(word_divergence(F.col("word_shares")))).alias("word_distance"))


def judge(documents: DataFrame, min_words: int = 40, min_reference: int = 2_000, class_limit: float = 0.12,
          word_limit: float = 0.4, short_slack: float = 1.2, languages: tuple[str, ...] | None = LANGUAGES) -> DataFrame:
    """One row per document: doc_id, base columns, base_failed, class_distance, word_distance
    (null where not compared), kept.

    Histograms of short texts are noisy (a telephone number is much of one), so the limit of the
    class distance is wider by ``short_slack`` over the square root of the number of words.

    References are made twice: of all documents that pass the base rules, and of those among
    them that lie within twice the limits of the first references, so that the bad text in
    the corpus does not move what it is compared with.
    """
    measured, with_all = stage(measure(documents, languages), "quality-counts"), languages is not None
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed)
    passed = measured.where("NOT base_failed")
    near = distances(passed, passed, min_words, min_reference, with_all).where(
        f"class_distance <= {2 * class_limit} AND word_distance <= {2 * word_limit}").select(*measured.columns)
    rows = distances(measured, near, min_words, min_reference, with_all).drop("language", "classes", "common")
    limit = class_limit + short_slack / F.sqrt("n_words")
    far = F.coalesce((F.col("class_distance") > limit) | (F.col("word_distance") > word_limit), F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~far)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: base counts and verdict of all documents, each language compared with itself."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), languages=None)
