"""Reports over the enriched and alert layers, and ad-hoc SQL over all layers.

Every report is one aggregation over one scan. Percentages are doubles.
"""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilcard.functions.cards import utc_hour
from vigilcard.operators.decisions import ALERT_LEVELS, LEVELS
from vigilcard.plans.partials import FROM_PARTIALS, SCENARIOS, percent, sweep
from vigilcard.sources.layers import LayerStore

TOP_CLIENTS = 20


def _rows() -> Column:
    return F.count(F.lit(1))


def _money(condition: Column, name: str) -> Column:
    return F.round(F.sum(F.when(condition, F.col("amount")).otherwise(F.lit(0.0))), 2).alias(name)


def _level(name: str) -> Column:
    return F.col("risk_level") == name


def ranking_clients_by_alerts(alerts: DataFrame, top: int = TOP_CLIENTS) -> DataFrame:
    """Customers with the most alerts."""
    ranked = alerts.groupBy("customer_id").agg(
        _rows().alias("total_alerts"),
        F.count_if(_level("block")).alias("block_count"),
        F.count_if(_level("review")).alias("review_count"),
        F.round(F.sum("amount"), 2).alias("total_suspicious_amount"),
        F.round(F.avg("risk_score"), 1).alias("avg_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
    )
    order = [F.desc("total_alerts"), F.desc("total_suspicious_amount"), F.asc("customer_id")]
    return ranked.orderBy(*order).limit(top)


def fraud_rate_by_category(enriched: DataFrame) -> DataFrame:
    """Alert rate and volume per merchant category."""
    alerted = F.col("risk_level").isin(*ALERT_LEVELS)
    by_category = enriched.groupBy("merchant_category").agg(
        _rows().alias("total_transactions"),
        F.count_if(_level("block")).alias("block_count"),
        F.count_if(_level("review")).alias("review_count"),
        F.count_if(alerted).alias("alert_count"),
        percent(F.count_if(alerted), _rows(), 2).alias("alert_rate_pct"),
        F.round(F.sum("amount"), 2).alias("total_volume_brl"),
        _money(_level("block"), "blocked_volume_brl"),
    )
    return by_category.orderBy(F.desc("alert_rate_pct"), F.desc("total_transactions"), "merchant_category")


def _labelled(enriched: DataFrame, labels: DataFrame) -> DataFrame:
    truth = labels.select("transaction_id", F.col("is_fraud").alias("_is_fraud"))
    joined = enriched.select("transaction_id", "triggered_rules").join(truth, "transaction_id", "left")
    return joined.select("triggered_rules", F.coalesce("_is_fraud", F.lit(False)).alias("is_fraud"))


def rule_effectiveness(enriched: DataFrame, labels: DataFrame) -> DataFrame:
    """True and false positives and precision of every rule that fired."""
    fired = enriched.filter(F.coalesce(F.size("triggered_rules"), F.lit(0)) > 0)
    hits = _labelled(fired, labels).select(F.explode("triggered_rules").alias("rule_name"), "is_fraud")
    by_rule = hits.groupBy("rule_name").agg(
        _rows().alias("times_triggered"),
        F.count_if(F.col("is_fraud")).alias("true_positives"),
        F.count_if(~F.col("is_fraud")).alias("false_positives"),
        percent(F.count_if(F.col("is_fraud")), _rows(), 2).alias("precision_pct"),
    )
    return by_rule.orderBy(F.desc("times_triggered"), F.desc("precision_pct"), "rule_name")


def false_positives_by_rule(enriched: DataFrame, labels: DataFrame) -> DataFrame:
    """False positives of every rule, also relative to all normal transactions.

    One join serves both: ``explode_outer`` keeps rows without rules, and a position marks
    the first entry of every transaction, so normal transactions are counted in the same
    aggregation that counts the rules. The aggregate has one row per rule.
    """
    entries = _labelled(enriched, labels).select("is_fraud", F.posexplode_outer("triggered_rules"))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    by_rule = entries.groupBy(F.col("col").alias("rule_name")).agg(
        _rows().alias("total_rule_triggers"),
        F.count_if(~F.col("is_fraud")).alias("false_positive_count"),
        F.count_if(first & ~F.col("is_fraud")).alias("_normal"),
    )
    normal = F.sum("_normal").over(Window.partitionBy())  # over one row per rule
    rate = percent(F.col("false_positive_count"), F.col("_all_normal"), 3)
    return (
        by_rule.withColumn("_all_normal", normal)
        .filter(F.col("rule_name").isNotNull())
        .select("rule_name", "false_positive_count", "total_rule_triggers", rate.alias("false_positive_rate_on_normal_pct"))
        .orderBy(F.desc("false_positive_count"), "rule_name")
    )


def volume_by_hour(enriched: DataFrame) -> DataFrame:
    """Transactions, decisions and volume per hour of the day (UTC)."""
    by_hour = enriched.groupBy(utc_hour(F.col("timestamp")).alias("hour_of_day")).agg(
        _rows().alias("total_transactions"),
        *[F.count_if(_level(name)).alias(f"{name}_count") for name in LEVELS],
        F.round(F.avg("risk_score"), 2).alias("avg_risk_score"),
        F.round(F.sum("amount"), 2).alias("total_volume_brl"),
    )
    return by_hour.orderBy("hour_of_day")


def threshold_sweep(enriched: DataFrame, scenarios: Iterable[tuple[str, float, float]]) -> DataFrame:
    """Decisions under other thresholds, for any list of (name, review from, block from).

    Rows are reduced to one per distinct score first, and only that small table meets the
    scenarios, whose number is a parameter of the report.
    """
    return sweep(enriched.groupBy("risk_score").agg(_rows().alias("n"), F.sum("amount").alias("volume")), scenarios)


def threshold_comparison(enriched: DataFrame) -> DataFrame:
    """The three stock scenarios side by side."""
    return threshold_sweep(enriched, SCENARIOS)


def false_positive_rate(enriched: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Share of alerts among normal transactions (all rows when there are no labels)."""
    rows = enriched.select("transaction_id", "risk_level")
    if labels is not None:
        fraud = labels.filter("is_fraud").select("transaction_id")
        rows = rows.join(fraud, "transaction_id", "left_anti")
    alerted = F.count_if(F.col("risk_level").isin(*ALERT_LEVELS))
    return rows.agg(
        _rows().alias("normal_transactions"),
        alerted.alias("false_alerts"),
        percent(alerted, _rows(), 3).alias("false_positive_rate_pct"),
    )


# Reports by name: the layers they read and the function that builds them.
REPORTS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "ranking_clients_by_alerts": (("alerts",), ranking_clients_by_alerts),
    "fraud_rate_by_category": (("enriched",), fraud_rate_by_category),
    "rule_effectiveness": (("enriched", "fraud_labels"), rule_effectiveness),
    "false_positives_by_rule": (("enriched", "fraud_labels"), false_positives_by_rule),
    "volume_by_hour": (("enriched",), volume_by_hour),
    "threshold_comparison": (("enriched",), threshold_comparison),
}


def run_query(spark: SparkSession, store: LayerStore, name_or_sql: str) -> DataFrame:
    """A report by name, or SQL text over the views raw, enriched, alerts and fraud_labels.

    Reports that partials can give are read from them if the store keeps them.
    """
    partials = store.read_report_partials() if name_or_sql in FROM_PARTIALS else None
    if partials is not None:
        return FROM_PARTIALS[name_or_sql](partials)
    store.register_views()
    if name_or_sql in REPORTS:
        layers, report = REPORTS[name_or_sql]
        return report(*[spark.table(layer) for layer in layers])
    if not name_or_sql.lstrip().upper().startswith(("SELECT", "WITH")):
        raise ValueError(f"unknown report {name_or_sql!r}; use one of {', '.join(REPORTS)} or a SELECT")
    return spark.sql(name_or_sql)
