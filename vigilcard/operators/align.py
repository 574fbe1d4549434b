"""Alignment of raw transactions and the split between batch and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilcard.functions.cards import BIN_LENGTH
from vigilcard.schemas import RAW

KEYS = ("card_key", "customer_key", "bin")
# The key of rows without card or customer: a text no id has.
MISSING = "chr(0)"


def align(df: DataFrame) -> DataFrame:
    """Raw columns plus the whole-second time and the window keys.

    A missing card or customer is one group of its own, apart from the empty text, so the
    keys are never null and plain equi-joins find every row again.
    """
    kept = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW.fields]
    if "dt" in df.columns:  # partition column of a stored layer, kept for pruning
        kept.append("dt")
    return df.selectExpr(*kept).selectExpr(
        "*",
        "unix_timestamp(timestamp) AS ts_epoch",
        f"coalesce(card_id, {MISSING}) AS card_key",
        f"coalesce(customer_id, {MISSING}) AS customer_key",
        f"coalesce(substring(card_id, 1, {BIN_LENGTH}), {MISSING}) AS bin",
    )


def without_ids_of(history: DataFrame, batch: DataFrame) -> DataFrame:
    """History rows whose id is not in the batch."""
    ids = batch.select("transaction_id").distinct()
    return history.join(ids, "transaction_id", "left_anti")


def since_seconds(df: DataFrame, since: int | None, reach: int = 0) -> DataFrame:
    """Rows at or after ``since - reach`` epoch seconds; all rows when ``since`` is None.

    The bound is stated on ``timestamp`` and, for a stored layer, on ``dt`` as well, so it
    prunes partitions and reaches the Parquet filters.
    """
    if since is None:
        return df
    if "dt" in df.columns:
        df = df.filter(F.col("dt") >= day_literal(since - reach))
    return df.filter(F.col("timestamp") >= F.timestamp_seconds(F.lit(since - reach)))


def day_literal(second: int) -> Column:
    """The UTC date of an epoch second."""
    return F.date_from_unix_date(F.lit(second // 86400))
