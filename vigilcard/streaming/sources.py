"""Streaming sources and the JSON form of a transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.config import EngineConfig
from vigilcard.functions.cards import time_text
from vigilcard.schemas import RAW


def parse_transactions(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to raw columns; a malformed line becomes a row of nulls."""
    return lines.select(_parsed(column)).select("tx.*")


def _parsed(column: str) -> Column:
    return F.from_json(F.col(column).cast("string"), RAW, {"timeZone": "UTC"}).alias("tx")


def parse_or_keep(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw columns of every line, and ``rejected_line``: the text of a line without an id.

    ``process_batch`` writes such lines to the rejected layer, so a stream loses none.
    """
    parsed = lines.select(F.col(column).cast("string").alias("line"), _parsed(column))
    unusable = F.col("tx.transaction_id").isNull()
    return parsed.select("tx.*", F.when(unusable, F.col("line")).alias("rejected_line"))


def split_bad_records(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parsed rows with an id, and the text of the lines without one."""
    parsed = lines.select(F.col(column).cast("string").alias("line"), _parsed(column))
    usable = F.col("tx.transaction_id").isNotNull()
    return parsed.filter(usable).select("tx.*"), parsed.filter(~usable).select("line")


def with_event_watermark(rows: DataFrame, config: EngineConfig) -> DataFrame:
    """Watermark on the transaction time."""
    return rows.withWatermark("timestamp", f"{config.streaming.watermark_seconds} seconds")


def read_kafka(spark: SparkSession, config: EngineConfig, servers: str, topic: str) -> DataFrame:
    """Transactions of a Kafka topic as a stream (needs the Kafka connector on the classpath).

    Lines without an id come along, see ``parse_or_keep``.
    """
    source = spark.readStream.format("kafka").options(
        **{
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": "latest",
            "failOnDataLoss": "false",
        }
    )
    return with_event_watermark(parse_or_keep(source.load()), config)


def read_json_lines(spark: SparkSession, config: EngineConfig, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-line files that arrive in a folder, as a stream.

    Lines without an id come along, see ``parse_or_keep``. A micro-batch takes all files that
    wait unless ``files_per_batch`` is given. Where micro-batches end matters: novelty ignores
    rows of the same micro-batch, so smaller ones see more of what came just before.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_event_watermark(parse_or_keep(reader.text(path)), config)


def transaction_json() -> Column:
    """One raw transaction as a JSON line: every field, nulls kept, ISO time."""
    iso = {"timestamp": time_text(F.col("timestamp"), "T").alias("timestamp")}
    fields = [iso.get(name, F.col(name)) for name in RAW.names]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
