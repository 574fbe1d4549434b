"""Partial aggregates that reports are made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilcard.functions.cards import utc_date, utc_hour


def report_partials(enriched: DataFrame) -> DataFrame:
    """Partial aggregates of enriched rows, with ``dt``."""
    keys = {"hour_of_day": utc_hour(F.col("timestamp")), "dt": utc_date(F.col("timestamp"))}
    return enriched.withColumns(keys).groupBy("dt", "merchant_category", "hour_of_day", "risk_level", "risk_score").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("volume"))
