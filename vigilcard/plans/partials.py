"""Reports from stored partial aggregates.

The enriched rows that a batch adds are reduced to one row per (merchant category, hour, level,
score) and date, with their number and volume. Sums of such rows are the same whatever the batches
were, so a report reads the partials of the dates it covers and never the layer itself. Levels and
scores follow from the rules that fired, so a date has few thousand rows whatever its size.

Missing categories, hours, levels and scores are groups of their own, and rows without an amount
count but add no volume, as in the direct reports. Volumes may differ from those of the direct
reports in their last binary digits, before rounding, as sums are taken in another order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilcard.operators.decisions import ALERT_LEVELS, LEVELS

# Threshold scenarios (name, review from, block from).
SCENARIOS = (
    ("Atual (30/70)", 30.0, 70.0),
    ("Conservador (25/60)", 25.0, 60.0),
    ("Agressivo (40/80)", 40.0, 80.0),
)


def percent(part: Column, whole: Column, decimals: int) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), decimals)


def _rows(condition: Column | None = None) -> Column:
    n = F.col("n") if condition is None else F.when(condition, F.col("n"))
    return F.coalesce(F.sum(n), F.lit(0)).cast("long")


def _volume(condition: Column | None = None) -> Column:
    volume = F.col("volume") if condition is None else F.when(condition, F.col("volume")).otherwise(F.lit(0.0))
    return F.round(F.sum(volume), 2)


def _average_score() -> Column:
    scored = _rows(F.col("risk_score").isNotNull())
    return F.round(F.try_divide(F.sum(F.col("risk_score") * F.col("n")), scored), 2)


def fraud_rate_by_category(partials: DataFrame) -> DataFrame:
    """Alert rate and volume per merchant category."""
    level = F.col("risk_level")
    alerted = _rows(level.isin(*ALERT_LEVELS))
    by_category = partials.groupBy("merchant_category").agg(
        _rows().alias("total_transactions"),
        _rows(level == "block").alias("block_count"),
        _rows(level == "review").alias("review_count"),
        alerted.alias("alert_count"),
        percent(alerted, _rows(), 2).alias("alert_rate_pct"),
        _volume().alias("total_volume_brl"),
        _volume(level == "block").alias("blocked_volume_brl"),
    )
    return by_category.orderBy(F.desc("alert_rate_pct"), F.desc("total_transactions"), "merchant_category")


def volume_by_hour(partials: DataFrame) -> DataFrame:
    """Transactions, decisions and volume per hour of the day (UTC)."""
    by_hour = partials.groupBy("hour_of_day").agg(
        _rows().alias("total_transactions"),
        *[_rows(F.col("risk_level") == name).alias(f"{name}_count") for name in LEVELS],
        _average_score().alias("avg_risk_score"),
        _volume().alias("total_volume_brl"),
    )
    return by_hour.orderBy("hour_of_day")


def sweep(by_score: DataFrame, scenarios: Iterable[tuple[str, float, float]]) -> DataFrame:
    """Decisions of (risk_score, n, volume) rows under the thresholds of each scenario."""
    score = F.col("risk_score")
    cases = F.array(
        *[
            F.struct(F.lit(name).alias("scenario"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))
            for name, low, high in scenarios
        ]
    )
    expanded = by_score.select("*", F.inline(cases))
    below, above = score < F.col("low"), score >= F.col("high")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    return expanded.groupBy("scenario").agg(
        rows_where(below).alias("approve_count"),
        rows_where(~below & ~above).alias("review_count"),
        rows_where(above).alias("block_count"),
        percent(rows_where(above), F.sum("n"), 2).alias("block_pct"),
        F.round(F.coalesce(F.sum(F.when(above, F.col("volume"))), F.lit(0.0)), 2).alias("blocked_amount_brl"),
    )


def threshold_sweep(partials: DataFrame, scenarios: Iterable[tuple[str, float, float]]) -> DataFrame:
    """Decisions under other thresholds, for any list of (name, review from, block from)."""
    return sweep(partials.groupBy("risk_score").agg(F.sum("n").alias("n"), F.sum("volume").alias("volume")), scenarios)


def threshold_comparison(partials: DataFrame) -> DataFrame:
    """The three stock scenarios side by side."""
    return threshold_sweep(partials, SCENARIOS)


def batch_stats(partials: DataFrame) -> DataFrame:
    """One row: rows processed, alerts, rows per decision and average score."""
    level = F.col("risk_level")
    return partials.agg(
        _rows().alias("processed"),
        _rows(level.isin(*ALERT_LEVELS)).alias("alerts"),
        *[_rows(level == name).alias(name) for name in LEVELS],
        F.coalesce(_average_score(), F.lit(0.0)).alias("avg_score"),
    )


# Reports that partials can give, by the names of the direct ones.
FROM_PARTIALS = {
    "fraud_rate_by_category": fraud_rate_by_category,
    "volume_by_hour": volume_by_hour,
    "threshold_comparison": threshold_comparison,
}

