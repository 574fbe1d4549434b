"""A corpus pipeline over the training-data operators.

Documents pass the stages of STAGES in order. A stage works on all that the one before kept and
returns the columns of ``documents``; the last returns the packed pieces. Models are fitted on
the stage's own input. Nulls, empty texts, repeated rows and empty tables are treated as each
operator's docstring says: toxicity keeps what scores below 0.5, the quality classifier what
scores 0.7 or more, the n-gram join one document of each connected group (documents without
shingles and without id all stay), the mix gives a row for each epoch of a document it takes.

SQL cannot express the stages with fitted models, so there is no ORACLE_SQL; the tests hold each
stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm import ngram_join, packing, quality, source_mix, toxicity
from vigilcard.llm.common import id_fold, stage

ORACLE_SQL = None


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, toxicity.training_labels(labels, "toxic", 5, 0))
    scored = toxicity.score(docs, model, keep=docs.columns)
    return scored.where("score < 0.5").select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    usable = labels.where(id_fold(4) != 2).select("doc_id", F.col("quality").cast("int").alias("label"))
    scored = quality.score(docs, quality.fit(docs, usable), keep=docs.columns)
    return scored.where("score >= 0.7").select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard 0.8."""
    return ngram_join.keep_one(docs, 5, 80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the source mix takes them."""
    return source_mix.apply(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their bins; the rows that the mix gives of a document, cut or
    whole, are a cluster."""
    return packing.pack(docs, cluster="doc_id")


STAGES = [
    ("toxicity", keep_civil),
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_distinct),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
