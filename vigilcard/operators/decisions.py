"""Scores, decisions and the tables derived from a scored batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilcard.config import EngineConfig, Thresholds
from vigilcard.functions.cards import bin_prefix, time_text
from vigilcard.operators import rules
from vigilcard.schemas import ALERT, AUDIT, ENRICHED, SNAPSHOT_FEATURES

ALERT_LEVELS = ("review", "block")
LEVELS = ("approve", "review", "block")

# Decimals kept in the enriched table.
DECIMALS = {
    "sum_10min": 2,
    "min_10min": 2,
    "amount_zscore": 3,
    "amount_vs_avg_ratio": 3,
    "distance_from_last_km": 3,
    "travel_speed_kmh": 3,
    "minutes_since_last": 3,
    "dormant_days": 3,
    "risk_score": 2,
}


def timestamp_literal(moment: datetime) -> Column:
    """A driver-side moment as a literal; a naive one is taken as UTC."""
    if moment.tzinfo is None:
        from datetime import timezone

        moment = moment.replace(tzinfo=timezone.utc)
    micros = int(moment.timestamp()) * 1_000_000 + moment.microsecond
    return F.timestamp_micros(F.lit(micros))


def risk_level(score: Column, thresholds: Thresholds) -> Column:
    """Decision bucket of a score."""
    return (
        F.when(score < thresholds.review_from, "approve")
        .when(score < thresholds.block_from, "review")
        .otherwise("block")
    )


def with_decision(features: DataFrame, config: EngineConfig, decision_ts: Column) -> DataFrame:
    """Adds fired rules, reasons, capped score and decision to unrounded features."""
    judged, flags = rules.with_conditions(features, config)
    capped = F.greatest(F.lit(0.0), F.least(F.lit(config.max_score), rules.total_weight(flags)))
    scored = judged.withColumns(
        {
            "risk_score": capped,
            "triggered_rules": rules.fired_names(flags),
            "rule_reasons": rules.fired_reasons(flags),
            "decision_timestamp": decision_ts,
            "model_version": F.lit(config.model_version),
        }
    )
    columns = [f"`{name}`" for name in features.columns]
    decided = ("triggered_rules", "rule_reasons", "decision_timestamp", "model_version")
    return scored.select(*columns, "risk_score", risk_level(F.col("risk_score"), config.thresholds).alias("risk_level"), *decided)


def enriched_transactions(scored: DataFrame) -> DataFrame:
    """The persisted 42-column table: rounded features and decisions, without internals."""
    derived = {
        "amount": "coalesce(amount, 0D)",
        "minutes_since_last": "coalesce(minutes_since_last, 0D)",
        "amount_vs_avg_ratio": "CASE WHEN amount_vs_avg_ratio = 0 THEN 1D ELSE amount_vs_avg_ratio END",
    }
    columns = []
    for name in ENRICHED.names:
        value = derived.get(name, name)
        if name in DECIMALS:
            value = f"round({value}, {DECIMALS[name]})"
        columns.append(f"{value} AS {name}")
    return scored.selectExpr(*columns)


def feature_snapshot() -> Column:
    """JSON of the unrounded features, reasons and score behind a decision."""
    times = {"prev_ts": time_text(F.col("prev_ts"), " ").alias("prev_ts")}
    features = [times.get(name, F.col(name)) for name in SNAPSHOT_FEATURES]
    score = F.round("risk_score", 2).alias("risk_score")
    return F.to_json(F.struct(*features, F.col("rule_reasons"), score), {"ignoreNullFields": "false"})


def alerts(scored: DataFrame) -> DataFrame:
    """Review and block decisions with the snapshot of their features."""
    derived = {
        "bin": F.coalesce(bin_prefix(F.col("card_id")), F.lit("None")),
        "amount": F.round(F.coalesce(F.col("amount"), F.lit(0.0)), 2),
        "risk_score": F.round("risk_score", 2),
        "feature_snapshot": feature_snapshot(),
    }
    chosen = scored.filter(F.col("risk_level").isin(*ALERT_LEVELS))
    return chosen.select(*[derived.get(name, F.col(name)).alias(name) for name in ALERT.names])


def audit_events(
    enriched: DataFrame, audit_ts: Column, query_id: str | None = None, epoch: int | None = None
) -> DataFrame:
    """One decision event per enriched row, ready for the JSON-lines audit log.

    Events of a micro-batch carry its query and epoch, so that a second delivery shows.
    """
    derived = {
        "event": F.lit("decision"),
        "timestamp": time_text(F.col("timestamp"), " "),
        "amount": F.coalesce(F.col("amount"), F.lit(0.0)),
        "risk_score": F.round(F.coalesce(F.col("risk_score"), F.lit(0.0)), 2),
        "audit_ts": _utc_text(audit_ts),
    }
    run = [F.lit(query_id).cast("string").alias("query_id"), F.lit(epoch).cast("long").alias("epoch")]
    return enriched.select(*[derived.get(name, F.col(name)).alias(name) for name in AUDIT.names], *run)


def alert_audit_events(alert_rows: DataFrame, audit_ts: Column) -> DataFrame:
    """Audit events of kind ``alert``: every alert column between the kind and the audit time."""
    stamp = _utc_text(audit_ts).alias("audit_ts")
    times = {"timestamp", "decision_timestamp"}
    columns = [time_text(F.col(c), " ").alias(c) if c in times else F.col(c) for c in alert_rows.columns]
    return alert_rows.select(F.lit("alert").alias("event"), *columns, stamp)


def _utc_text(moment: Column) -> Column:
    return F.concat(time_text(moment, "T"), F.lit("+00:00"))


def batch_stats(enriched: DataFrame) -> DataFrame:
    """One row: rows processed, alerts, rows per decision and average score."""
    level = F.col("risk_level")
    return enriched.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(level.isin(*ALERT_LEVELS)).alias("alerts"),
        *[F.count_if(level == name).alias(name) for name in LEVELS],
        F.round(F.coalesce(F.avg("risk_score"), F.lit(0.0)), 2).alias("avg_score"),
    )


def rule_trigger_counts(enriched: DataFrame) -> DataFrame:
    """How often each rule fired."""
    fired = enriched.select(F.explode("triggered_rules").alias("rule_name"))
    return fired.groupBy("rule_name").agg(F.count(F.lit(1)).alias("times_triggered"))
