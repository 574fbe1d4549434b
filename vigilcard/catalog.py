"""The registered queries: every operator of the engine over transactions derived from ``events``.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame. Timestamps leave as zone-free
timestamps, arrays as comma-joined text, and doubles are rounded, so that results compare
across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, TimestampType

from vigilcard.config import EngineConfig, default_config
from vigilcard.functions import amounts, cards, geo
from vigilcard.functions.merchants import with_merchant_label
from vigilcard.operators import decisions
from vigilcard.operators.align import align, without_ids_of
from vigilcard.operators.novelty import seen_values, with_novelty
from vigilcard.operators.profiles import card_profiles
from vigilcard.operators.seconds import with_windows
from vigilcard.plans import fixtures, partials, reports
from vigilcard.plans.batch import backfill, process_batch
from vigilcard.plans.replay import verify_replay
from vigilcard.plans.scoring import rule_hits, score_transactions, transaction_features, with_row_features
from vigilcard.schemas import ALERT, AUDIT, ENRICHED, RAW
from vigilcard.sources.layers import JSON_LINES, LayerStore, csv_ready, csv_schema, distinct_events
from vigilcard.sources.scratch import Scratch, freed_shuffles, scratch_path
from vigilcard.streaming import jobs, sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DECIDED_AT = datetime(2024, 2, 1)
BACKFILL_LIMIT = 1000
SWEEP = [(f"{low}/{high}", float(low), float(high)) for low in (20, 35, 50) for high in (60, 75, 90)]
# Start of the second micro-batch of the session statistics, and of the second profile batch.
LATER = "2024-01-25 00:00:00"


def query(name: str) -> Callable[[Query], Query]:
    """Registers a query under ``name``."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return add


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History, batch and all rows, derived once; the many steps of a query read their columns back."""
    late = F.col("timestamp") >= F.timestamp_seconds(F.lit(fixtures.SPLIT_EPOCH))
    derived = fixtures.transactions(spark, sf_dir).withColumn("late", late)
    rows = Scratch(spark).stage(derived, "transactions", "late")
    return rows.filter("NOT late").drop("late"), rows.filter("late").drop("late"), rows.drop("late")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Aligned history and batch."""
    history, batch, _ = _staged(spark, sf_dir)
    return (
        align(history).withColumn("is_batch", F.lit(False)),
        align(batch).withColumn("is_batch", F.lit(True)),
    )


def _windows(spark: SparkSession, sf_dir: str, *families: str) -> DataFrame:
    past, rows = _sides(spark, sf_dir)
    return with_windows(rows, past, fixtures.SPLIT_EPOCH, history_ended=True, families=families)


def _features(spark: SparkSession, sf_dir: str, *families: str) -> DataFrame:
    history, batch, _ = _staged(spark, sf_dir)
    return transaction_features(batch, history, default_config(), fixtures.SPLIT_EPOCH, True, families)


def _novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, rows = _sides(spark, sf_dir)
    return with_novelty(rows, rows, seen_values(past))


def _scored(spark: SparkSession, sf_dir: str, config: EngineConfig | None = None) -> DataFrame:
    history, batch, _ = _staged(spark, sf_dir)
    return _score(batch, history, config)


def _score(batch: DataFrame, history: DataFrame, config: EngineConfig | None = None) -> DataFrame:
    return score_transactions(
        batch, history, config or default_config(), DECIDED_AT, fixtures.SPLIT_EPOCH, history_ended=True
    )


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.enriched_transactions(_scored(spark, sf_dir))


def _store(spark: SparkSession, name: str) -> LayerStore:
    return LayerStore(spark, scratch_path(spark, name))


def _rounded(name: str, decimals: int) -> Column:
    return F.round(F.col(name), decimals).alias(name)


def comparable(df: DataFrame, *leave_out: str) -> DataFrame:
    """A table in the form the comparison expects, without the named columns."""
    columns = []
    for f in df.schema.fields:
        value = f.name
        if isinstance(f.dataType, ArrayType):
            value = f"concat_ws(',', {f.name})"
        elif isinstance(f.dataType, TimestampType):
            value = f"convert_timezone(current_timezone(), 'UTC', CAST({f.name} AS timestamp_ntz))"
        elif f.name == "dt":
            value = "CAST(dt AS string)"
        if f.name not in leave_out:
            columns.append(f"{value} AS {f.name}")
    return df.selectExpr(*columns)


# Fields of the feature snapshot that are compared, by type; doubles with their decimals.
SNAPSHOT_WHOLE = (
    "velocity_1min", "velocity_5min", "velocity_1h", "velocity_24h", "count_10min", "amount_count_90d",
    "bin_denials_15min", "hour_of_day",
)
SNAPSHOT_TEXT = (
    "prev_ts", "prev_merchant_city", "prev_terminal_id", "prev_device_id", "prev_entry_mode",
    "previous_transaction_id", "prev_bin_approved", "new_terminal", "new_device", "new_city",
    "entry_mode_chip_only_history", "high_risk_merchant",
)
SNAPSHOT_DOUBLES = {
    "sum_10min": 2, "min_10min": 2, "amount_mean_90d": 8, "prev_amount": 2, "distance_from_last_km": 4,
    "travel_speed_kmh": 4, "minutes_since_last": 4, "dormant_days": 6, "amount_zscore": 4, "amount_vs_avg_ratio": 4,
    "risk_score": 2,
}


def _snapshot_fields(alert_rows: DataFrame) -> DataFrame:
    """Alerts with the fields of their snapshot as one text in place of its JSON form."""
    text = F.col("feature_snapshot")
    whole = [F.get_json_object(text, f"$.{n}") for n in (*SNAPSHOT_WHOLE, *SNAPSHOT_TEXT)]
    doubles = [
        F.round(F.get_json_object(text, f"$.{n}").cast("double"), d).cast(f"decimal(30,{d})").cast("string")
        for n, d in SNAPSHOT_DOUBLES.items()
    ]
    parts = [F.coalesce(part, F.lit("-")) for part in [*whole, *doubles]]
    return alert_rows.withColumn("feature_snapshot", F.concat_ws("|", *parts))


# --- projections, keys and single features -------------------------------------------------


@query("align_transactions")
def align_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align(fixtures.transactions(spark, sf_dir)).drop("card_key", "customer_key")
    return comparable(rows.withColumnRenamed("timestamp", "ts"))


@query("bin_from_card")
def bin_from_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    dashed = F.concat_ws("-", F.substring("card_id", 1, 4), F.substring("card_id", 5, 12))
    return rows.select(
        "transaction_id",
        cards.bin_from_card(F.col("card_id")).alias("bin_plain"),
        cards.bin_from_card(dashed).alias("bin_dashed"),
        cards.bin_from_card(F.col("merchant_city")).alias("bin_without_digits"),
    )


@query("history_excluding_batch")
def history_excluding_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, _ = fixtures.history_and_batch(spark, sf_dir)
    batch = fixtures.transactions(spark, sf_dir).filter(F.col("auth_result") == "approved")
    return without_ids_of(history, batch).select("transaction_id", "card_id")


@query("velocity_features")
def velocity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, "card").select(
        "transaction_id",
        "velocity_1min",
        "velocity_5min",
        "velocity_1h",
        "velocity_24h",
        "count_10min",
        _rounded("sum_10min", 2),
        _rounded("min_10min", 2),
    )


@query("previous_transaction")
def previous_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        _windows(spark, sf_dir, "card").select(
            "transaction_id",
            "prev_ts",
            "prev_merchant_city",
            "prev_terminal_id",
            "prev_device_id",
            "prev_amount",
            "prev_entry_mode",
            "previous_transaction_id",
        )
    )


@query("previous_in_hot_second")
def previous_in_hot_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row before of card and BIN when half of all rows share one card and one second."""
    hot = F.substring("transaction_id", -1, 1).cast("int") % 2 == 0
    rows = fixtures.transactions(spark, sf_dir).withColumns({
        "card_id": F.when(hot, "4532010000000001").otherwise(F.col("card_id")),
        "timestamp": F.when(hot, F.timestamp_seconds(F.lit(fixtures.SPLIT_EPOCH + 60))).otherwise(F.col("timestamp"))})
    split = F.timestamp_seconds(F.lit(fixtures.SPLIT_EPOCH))
    past = align(rows.filter(F.col("timestamp") < split)).withColumn("is_batch", F.lit(False))
    batch = align(rows.filter(F.col("timestamp") >= split)).withColumn("is_batch", F.lit(True))
    found = with_windows(batch, past, fixtures.SPLIT_EPOCH, history_ended=True, families=("card", "bin"))
    return comparable(found.select("transaction_id", "prev_ts", "prev_amount", "previous_transaction_id", "prev_bin_approved"))


@query("amount_profile")
def amount_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "customer").select(
        "transaction_id",
        _rounded("amount_mean_90d", 8),
        _rounded("amount_std_90d", 6),
        "amount_count_90d",
        _rounded("amount_zscore", 4),
        _rounded("amount_vs_avg_ratio", 4),
    )


@query("amount_profile_partials")
def amount_profile_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``amount_profile``, with history's whole days from stored moments of two batches."""
    history, batch = fixtures.history_and_batch(spark, sf_dir)
    store, late = _store(spark, "layers"), F.substring("transaction_id", -1, 1) == "7"
    for part in (history.filter(~late), history.filter(late)):
        store.append_new("raw", part)
        store.write_day_moments(part)
    rows = align(batch).withColumn("is_batch", F.lit(True))
    past = align(store.read("raw")).withColumn("is_batch", F.lit(False))
    days = [r[0] for r in rows.select(F.expr("ts_epoch div 86400")).distinct().collect()]
    featured = with_windows(rows, past, fixtures.SPLIT_EPOCH, history_ended=True, families=("customer",),
                            moments=store.read_day_moments(), days=days)
    return with_row_features(featured, default_config(), ("customer",)).select(
        "transaction_id",
        _rounded("amount_mean_90d", 8),
        _rounded("amount_std_90d", 6),
        "amount_count_90d",
        _rounded("amount_zscore", 4),
        _rounded("amount_vs_avg_ratio", 4),
    )


@query("amount_profile_large")
def amount_profile_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation of amounts that are ten million larger."""
    sides = [rows.withColumn("amount", F.col("amount") + 1e7) for rows in fixtures.history_and_batch(spark, sf_dir)]
    rows = transaction_features(sides[1], sides[0], default_config(), fixtures.SPLIT_EPOCH, True, ("customer",))
    return rows.select("transaction_id", _rounded("amount_std_90d", 5), "amount_count_90d")


@query("amount_zscore_guarded")
def amount_zscore_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = amounts.zscore_guarded(F.col("amount"), F.col("amount_mean_90d"), F.col("amount_std_90d"))
    return _windows(spark, sf_dir, "customer").select("transaction_id", F.round(score, 4).alias("amount_zscore"))


@query("unusual_amount_flag")
def unusual_amount_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = amounts.unusual_amount(F.col("amount"), F.col("amount_mean_90d"), F.col("amount_std_90d"))
    return _windows(spark, sf_dir, "customer").select("transaction_id", flag.alias("unusual_amount"))


@query("customer_mean_std")
def customer_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = amounts.mean_and_deviation(fixtures.transactions(spark, sf_dir), "customer_id")
    return stats.select("customer_id", _rounded("amount_mean", 4), _rounded("amount_std", 4))


@query("bin_denials")
def bin_denials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, "bin").select("transaction_id", "bin", "bin_denials_15min", "prev_bin_approved")


@query("geo_distance_speed")
def geo_distance_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "card").select(
        "transaction_id",
        _rounded("minutes_since_last", 4),
        _rounded("distance_from_last_km", 4),
        _rounded("travel_speed_kmh", 4),
    )


@query("impossible_travel_flag")
def impossible_travel_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = geo.impossible_travel(F.col("distance_from_last_km"), F.col("travel_speed_kmh"))
    return _features(spark, sf_dir, "card").select("transaction_id", flag.alias("impossible_travel"))


@query("dormancy")
def dormancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "card").select(
        "transaction_id", _rounded("dormant_days", 6), cards.dormant(F.col("dormant_days")).alias("is_dormant")
    )


@query("hour_of_day")
def hour_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = cards.hour_of_day(F.col("timestamp"))
    rows = fixtures.transactions(spark, sf_dir).select("transaction_id", hour.alias("hour_of_day"))
    return rows.withColumn("untrusted_hour", cards.untrusted_hour(F.col("hour_of_day")))


@query("high_velocity_flag")
def high_velocity_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, "card").select(
        "transaction_id",
        cards.high_velocity(F.col("velocity_1min"), 60).alias("high_1min"),
        cards.high_velocity(F.col("velocity_24h"), 86400).alias("high_24h"),
        cards.high_velocity(F.col("count_10min"), 600, limit=1).alias("any_10min"),
    )


@query("velocity_monotonic_check")
def velocity_monotonic_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [F.col(c) for c in ("velocity_1min", "velocity_5min", "velocity_1h", "velocity_24h")]
    return _windows(spark, sf_dir, "card").agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(~cards.monotonic_counts(*counts)).alias("violations"),
    )


@query("novelty_flags")
def novelty_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _novelty(spark, sf_dir).select("transaction_id", "new_terminal", "new_device", "new_city")


@query("chip_only_history")
def chip_only_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _novelty(spark, sf_dir).select("transaction_id", "entry_mode_chip_only_history")


@query("new_device_strict")
def new_device_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = F.col("new_device") & ~cards.is_blank(F.col("device_id"))
    return _novelty(spark, sf_dir).select("transaction_id", strict.alias("new_device"))


@query("two_devices_flag")
def two_devices_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = cards.two_devices(F.col("device_id"), F.col("prev_device_id"))
    return _windows(spark, sf_dir, "card").select("transaction_id", flag.alias("two_devices"))


@query("seen_sets")
def seen_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, _ = fixtures.history_and_batch(spark, sf_dir)
    return seen_values(history).select("card_id", F.col("kind").cast("long").alias("kind"), "value")


@query("high_risk_merchant")
def high_risk_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    padded = F.concat(F.lit(" "), F.col("merchant_category"), F.lit(" "))
    return rows.select("transaction_id", cards.high_risk_merchant(padded).alias("high_risk_merchant"))


@query("merchant_labels")
def merchant_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fixtures.merchant_names(spark, sf_dir)
    rows = fixtures.transactions(spark, sf_dir).select("transaction_id", "merchant_id", "merchant_category")
    return with_merchant_label(rows, names).select("transaction_id", "merchant_id", "merchant_label")


# --- rules and decisions --------------------------------------------------------------------


def _rule_query(name: str) -> None:
    @query(f"rule_{name}")
    def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
        history, batch = fixtures.history_and_batch(spark, sf_dir)
        config = default_config().with_rules([name])
        return rule_hits(batch, history, config, fixtures.SPLIT_EPOCH, history_ended=True)


for _name in (rule.name for rule in default_config().rules):
    _rule_query(_name)


@query("rules_disabled_subset")
def rules_disabled_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = default_config().with_rules(["unusual_amount", "new_device_high_amount", "bin_attack"])
    rows = _scored(spark, sf_dir, config).select("transaction_id", "risk_score", "risk_level", "triggered_rules")
    return comparable(rows)


@query("rule_reasons")
def rule_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = _scored(spark, sf_dir).filter(F.size("rule_reasons") > 0)
    return fired.select("transaction_id", F.concat_ws(" | ", "rule_reasons").alias("rule_reasons"))


@query("risk_scores")
def risk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        _scored(spark, sf_dir).select("transaction_id", "risk_score", "risk_level", "triggered_rules", "model_version")
    )


@query("enriched_transactions")
def enriched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_enriched(spark, sf_dir))


@query("alerts")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decisions.alerts(_scored(spark, sf_dir))
    return comparable(_snapshot_fields(rows))


@query("alert_feature_snapshot")
def alert_feature_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decisions.alerts(_scored(spark, sf_dir)).select("transaction_id", "feature_snapshot")
    text = F.col("feature_snapshot")
    whole = {name: f"$.{name}" for name in ("velocity_24h", "amount_count_90d", "hour_of_day", "bin_denials_15min")}
    plain = {
        name: f"$.{name}"
        for name in ("prev_ts", "prev_merchant_city", "prev_device_id", "previous_transaction_id", "new_city")
    }
    doubles = {"amount_mean_90d": 8, "distance_from_last_km": 4, "risk_score": 2}
    return rows.select(
        "transaction_id",
        *[F.get_json_object(text, path).cast("long").alias(name) for name, path in whole.items()],
        *[F.get_json_object(text, path).alias(name) for name, path in plain.items()],
        *[F.round(F.get_json_object(text, f"$.{n}").cast("double"), d).alias(n) for n, d in doubles.items()],
        F.json_array_length(F.get_json_object(text, "$.rule_reasons")).cast("long").alias("reasons"),
        F.size(F.json_object_keys(text)).cast("long").alias("fields"),
    )


@query("batch_stats")
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.batch_stats(_enriched(spark, sf_dir))


@query("rule_trigger_counts")
def rule_trigger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.rule_trigger_counts(_enriched(spark, sf_dir))


# --- reports --------------------------------------------------------------------------------


@query("ranking_clients_by_alerts")
def ranking_clients_by_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ranking_clients_by_alerts(decisions.alerts(_scored(spark, sf_dir)))


@query("fraud_rate_by_category")
def fraud_rate_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fraud_rate_by_category(_enriched(spark, sf_dir))


@query("rule_effectiveness")
def rule_effectiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rule_effectiveness(_enriched(spark, sf_dir), fixtures.fraud_labels(spark, sf_dir))


@query("false_positives_by_rule")
def false_positives_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.false_positives_by_rule(_enriched(spark, sf_dir), fixtures.fraud_labels(spark, sf_dir))


@query("volume_by_hour")
def volume_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.volume_by_hour(_enriched(spark, sf_dir))


@query("threshold_comparison")
def threshold_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.threshold_comparison(_enriched(spark, sf_dir))


@query("threshold_sweep")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.threshold_sweep(_enriched(spark, sf_dir), SWEEP)


@query("false_positive_rate")
def false_positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.false_positive_rate(_enriched(spark, sf_dir), fixtures.fraud_labels(spark, sf_dir))


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of three batches: one stored before partials were kept, one taken back and
    delivered again, all dates compacted at the end."""
    rows, store = Scratch(spark).stage(_enriched(spark, sf_dir), "enriched"), _store(spark, "layers")
    store.append_new("enriched", rows.filter(~_later()))
    store.keep_report_partials()
    later = rows.filter(_later() | F.col("timestamp").isNull())
    killed = LayerStore(spark, store.root)
    try:
        with killed.batch("query"):
            killed.append_new("enriched", later)
            raise _Killed
    except _Killed:
        pass
    with store.batch("query"):
        store.append_new("enriched", later.filter("channel = 'atm'"))
    store.append_new("enriched", rows)
    store.compact("report_partials", 2)
    return store.read_report_partials()


@query("report_partials")
def report_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partials.fraud_rate_by_category(_partials(spark, sf_dir))


@query("report_partials_by_hour")
def report_partials_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partials.volume_by_hour(_partials(spark, sf_dir))


@query("report_partials_thresholds")
def report_partials_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partials.threshold_sweep(_partials(spark, sf_dir), SWEEP)


# --- layers ---------------------------------------------------------------------------------


@query("layer_roundtrip_raw")
def layer_roundtrip_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "layers")
    store.append_new("raw", fixtures.transactions(spark, sf_dir))
    return comparable(store.read("raw"))


def _processed(spark: SparkSession, sf_dir: str) -> LayerStore:
    """Layers after processing the batch against stored history."""
    history, batch, _ = _staged(spark, sf_dir)
    store = _store(spark, "layers")
    store.append_new("raw", history)
    process_batch(batch, store, default_config(), DECIDED_AT).release()
    return store


@query("layer_roundtrip_enriched")
def layer_roundtrip_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_processed(spark, sf_dir).read("enriched"))


@query("snapshot_scoring")
def snapshot_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``layer_roundtrip_enriched``, from snapshots that late rows of history were added to."""
    history, batch, _ = _staged(spark, sf_dir)
    store = _store(spark, "layers")
    late = F.substring("transaction_id", -1, 1) == "7"
    store.append_new("raw", history.filter(~late))
    for day in (date(2024, 1, 10), date(2024, 1, 19)):
        store.write_snapshot(day)
    rows = history.filter(late)
    store.append_new("raw", rows)
    store.add_late_rows(rows, None)
    process_batch(batch, store, default_config(), DECIDED_AT, keep_snapshots=True).release()
    return comparable(store.read("enriched"))


@query("layer_roundtrip_alerts")
def layer_roundtrip_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_snapshot_fields(_processed(spark, sf_dir).read("alerts")))


@query("upsert_idempotent")
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, _, everything = _staged(spark, sf_dir)
    store = _store(spark, "layers")
    store.append_new("raw", history)
    again = everything.unionByName(everything).withColumn("amount", F.col("amount") + 1000)
    store.append_new("raw", again)
    return store.read("raw").select("transaction_id", _rounded("amount", 2))


@query("upsert_id_index")
def upsert_id_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History in three batches, then everything: what raw holds and what its id index knows."""
    history, _, everything = _staged(spark, sf_dir)
    store = _store(spark, "layers")
    for k in range(3):
        store.append_new("raw", history.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == k))
    store.append_new("raw", everything.withColumn("amount", F.col("amount") + 1000))
    known = store.indexed_ids().withColumn("indexed", F.lit(True))
    both = store.read("raw").select("transaction_id", _rounded("amount", 2)).join(known, "transaction_id", "full")
    return both.withColumn("indexed", F.coalesce("indexed", F.lit(False)))


class _Killed(Exception):
    """Stands for the end of a process between two layers."""


class _KilledStore(LayerStore):
    """A store whose process ends before the audit log is written."""

    def append_audit(self, events: DataFrame) -> None:
        raise _Killed


@query("layer_commit_recovery")
def layer_commit_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is killed before its audit events is absent; delivered again it is there once."""
    history, batch, _ = _staged(spark, sf_dir)
    store = _store(spark, "layers")
    store.append_new("raw", history)
    run = ("query", 0)
    try:
        process_batch(batch, _KilledStore(spark, store.root), default_config(), DECIDED_AT, run=run)
    except _Killed:
        pass
    counts = [store.read("raw").agg(F.lit("raw before").alias("layer"), F.count(F.lit(1)).alias("n"))]
    counts[0] = Scratch(spark).stage(counts[0], "counts")
    process_batch(batch, LayerStore(spark, store.root), default_config(), DECIDED_AT, run=run).release()
    layers = {name: store.read(name) for name in ("raw", "enriched", "alerts")}
    layers |= {"audit": store.read_audit(), "profiles": store.read_profiles(), "ids": store.indexed_ids()}
    counts += [table.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("n")) for name, table in layers.items()]
    return reduce(DataFrame.union, counts)


@query("layer_compaction")
def layer_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw after nine batches over the same dates and two compactions, one of them between."""
    _, _, rows = _staged(spark, sf_dir)
    store, part = _store(spark, "layers"), F.pmod(F.xxhash64("transaction_id"), F.lit(9))
    for k in range(9):
        store.append_new("raw", rows.filter(part == k))
        if k == 4:
            store.compact("raw", 4)
    store.compact("raw", 4)
    return comparable(store.read("raw"))


@query("audit_log")
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "layers")
    now = decisions.timestamp_literal(DECIDED_AT)
    store.append_audit(decisions.audit_events(_enriched(spark, sf_dir), now))
    return comparable(store.read_audit().select(*AUDIT.names))


@query("audit_alert_events")
def audit_alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "layers")
    now = decisions.timestamp_literal(DECIDED_AT)
    store.append_audit(decisions.alert_audit_events(decisions.alerts(_scored(spark, sf_dir)), now))
    events = store.read_audit().select("event", *ALERT.names, "audit_ts")
    return comparable(_snapshot_fields(events))


@query("export_alerts_csv")
def export_alerts_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, target = _store(spark, "layers"), scratch_path(spark, "export")
    store.append_new("alerts", decisions.alerts(_scored(spark, sf_dir)))
    store.export("alerts", target, "csv")
    written = csv_schema(csv_ready(store.read("alerts")).schema)
    rows = spark.read.schema(written).option("header", True).option("escape", '"').option("timeZone", "UTC").csv(target)
    rules = F.concat_ws(",", F.from_json("triggered_rules", ArrayType(ALERT["transaction_id"].dataType)))
    reasons = F.concat_ws(",", F.from_json("rule_reasons", ArrayType(ALERT["transaction_id"].dataType)))
    chosen = rows.withColumn("triggered_rules", rules).withColumn("rule_reasons", reasons)
    return comparable(_snapshot_fields(chosen))


@query("export_enriched_json")
def export_enriched_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, target = _store(spark, "layers"), scratch_path(spark, "export")
    store.append_new("enriched", _enriched(spark, sf_dir))
    store.export("enriched", target, "json")
    return comparable(spark.read.schema(ENRICHED).option("timeZone", "UTC").json(target))


@query("export_raw_parquet")
def export_raw_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, target = _store(spark, "layers"), scratch_path(spark, "export")
    store.append_new("raw", fixtures.transactions(spark, sf_dir))
    store.export("raw", target, "parquet")
    return comparable(spark.read.schema(RAW).parquet(target))


@query("views_empty_layers")
def views_empty_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "layers")
    store.append_new("raw", fixtures.transactions(spark, sf_dir))
    store.register_views()
    counts = [spark.table(v).agg(F.lit(v).alias("view"), F.count(F.lit(1)).alias("n")) for v in
              ("raw", "enriched", "alerts", "fraud_labels")]
    return reduce(DataFrame.union, counts)


@query("adhoc_sql")
def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "layers")
    store.append_new("raw", fixtures.transactions(spark, sf_dir))
    store.write_labels(fixtures.fraud_labels(spark, sf_dir))
    return reports.run_query(
        spark,
        store,
        """
        SELECT r.merchant_city, r.entry_mode, l.fraud_type, COUNT(*) AS n, ROUND(SUM(r.amount), 2) AS volume
        FROM raw r JOIN fraud_labels l ON r.transaction_id = l.transaction_id
        GROUP BY r.merchant_city, r.entry_mode, l.fraud_type
        """,
    )


@query("backfill_decisions")
def backfill_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfilled(spark, sf_dir, 0)


@query("backfill_limit")
def backfill_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfilled(spark, sf_dir, BACKFILL_LIMIT)


def _backfilled(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    """Decisions of a first backfill from Parquet, with no history at all."""
    source = scratch_path(spark, "source")
    fixtures.transactions(spark, sf_dir).write.parquet(source)
    result = backfill(spark, source, _store(spark, "layers"), default_config(), limit, DECIDED_AT, write=False)
    return comparable(result.enriched.select("transaction_id", "risk_score", "risk_level", "triggered_rules"))


# --- profiles and replay --------------------------------------------------------------------


def _later(column: str = "timestamp") -> Column:
    return F.col(column) >= F.lit(LATER).cast("timestamp")


@query("card_profiles")
def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = decisions.timestamp_literal(DECIDED_AT)
    return comparable(card_profiles(_enriched(spark, sf_dir), now))


@query("card_profiles_merge")
def profiles_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches through the store, the middle one without cards, then all deltas as one."""
    now = decisions.timestamp_literal(DECIDED_AT)
    rows, store = Scratch(spark).stage(_enriched(spark, sf_dir), "enriched"), _store(spark, "layers")
    for part in (rows.filter(~_later()), rows.withColumn("card_id", F.lit(None).cast("string")), rows.filter(_later())):
        store.write_profiles(card_profiles(part, now))
    store.compact_profiles()
    return comparable(store.read_profiles())


def _verdicts(history: DataFrame, batch: DataFrame, raw: DataFrame, ids: DataFrame) -> DataFrame:
    stored = decisions.enriched_transactions(_score(batch, history))
    return comparable(verify_replay(raw, stored, default_config(), DECIDED_AT, ids))


@query("replay_verify")
def replay_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch, everything = _staged(spark, sf_dir)
    return _verdicts(history, batch, everything, batch.select("transaction_id"))


@query("replay_one_id")
def replay_one_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first transaction of the batch alone, over the stored raw layer."""
    history, batch, everything = _staged(spark, sf_dir)
    store = _store(spark, "layers")
    store.append_new("raw", everything)
    first = batch.agg(F.min("transaction_id").alias("transaction_id"))
    return _verdicts(history, batch, store.read("raw"), first)


@query("replay_missing")
def replay_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of history were never scored, and declined rows are taken out of raw."""
    history, batch, everything = _staged(spark, sf_dir)
    raw = everything.filter(F.col("auth_result") == "approved")
    verdicts = _verdicts(history, batch, raw, everything.select("transaction_id"))
    return verdicts.filter(F.col("status").startswith("not_in")).select("transaction_id", "status", "idempotent")


# --- streaming ------------------------------------------------------------------------------


@query("transactions_as_json")
def transactions_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.transactions(spark, sf_dir).select("transaction_id", sources.transaction_json().alias("value"))


def _write_lines(rows: DataFrame, path: str, broken: Column | None = None) -> str:
    """Rows as JSON-line files; lines where ``broken`` holds are cut in half."""
    line = sources.transaction_json()
    if broken is not None:
        line = F.when(broken, F.substring(line, 1, 60)).otherwise(line)
    rows.select(line.alias("value")).write.mode("append").options(**JSON_LINES).text(path)
    return path


def _drain(stream: DataFrame, spark: SparkSession) -> str:
    """Runs a stream over all waiting input into a new Parquet folder."""
    target = scratch_path(spark, "stream-out")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "checkpoint"))
    writer.trigger(availableNow=True).start(target).awaitTermination()
    return target


@query("stream_parse_json")
def stream_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    broken = F.col("channel") == "atm"
    path = _write_lines(rows, scratch_path(spark, "lines"), broken)
    good, bad = sources.split_bad_records(spark.readStream.text(path))
    parsed = spark.read.schema(RAW).parquet(_drain(good, spark))
    rejected = spark.read.schema("line string").parquet(_drain(bad, spark))
    labelled = rejected.select(F.lit("rejected").alias("outcome"), F.col("line").alias("transaction_id"))
    return comparable(
        parsed.withColumn("outcome", F.lit("parsed")).unionByName(labelled, allowMissingColumns=True)
    )


@query("stream_watermark")
def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark alone drops nothing: rows 200 days behind the newest pass."""
    path = _write_lines(fixtures.transactions(spark, sf_dir), scratch_path(spark, "lines"))
    stream = sources.read_json_lines(spark, default_config(), path)
    rows = spark.read.schema(RAW).parquet(_drain(stream, spark))
    return comparable(rows.select("transaction_id", "timestamp"))


def _streamed(
    spark: SparkSession, sf_dir: str, batches: list[Column], runs: int = 1, own_folders: bool = False
) -> LayerStore:
    """Layers after streaming the batch rows, one micro-batch per condition, over stored history.

    With ``own_folders`` every condition has a folder and a checkpoint, so a query, of its own.
    """
    history, batch, _ = _staged(spark, sf_dir)
    store, lines = _store(spark, "layers"), scratch_path(spark, "lines")
    store.append_new("raw", history)
    for condition in batches:
        lines = scratch_path(spark, "lines") if own_folders else lines
        _write_lines(batch.filter(condition), lines)
        for run in range(runs):
            stream = sources.read_json_lines(spark, default_config(), lines)
            checkpoint = f"{lines}-checkpoint-{run}"
            jobs.start_scoring(
                stream, store, default_config(), checkpoint, available_now=True, decision_ts=DECIDED_AT
            ).awaitTermination()
    return store


@query("stream_decisions")
def stream_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _streamed(spark, sf_dir, [F.lit(True)])
    return comparable(store.read("enriched"))


@query("stream_rejected_records")
def stream_rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a stream is in raw or in the rejected layer; ATM rows are broken off and
    contactless ones have no id."""
    rows = fixtures.transactions(spark, sf_dir)
    nameless = F.when(F.col("entry_mode") != "contactless", F.col("transaction_id"))
    lines = _write_lines(rows.withColumn("transaction_id", nameless), scratch_path(spark, "lines"), F.col("channel") == "atm")
    store = _store(spark, "layers")
    jobs.start_scoring(
        sources.read_json_lines(spark, default_config(), lines), store, default_config(),
        scratch_path(spark, "checkpoint"), available_now=True, decision_ts=DECIDED_AT,
    ).awaitTermination()
    kept = store.read("raw").select(F.lit("raw").alias("layer"), F.col("transaction_id").alias("content"))
    return kept.unionByName(store.read_rejected().select(F.lit("rejected").alias("layer"), F.col("line").alias("content")))


@query("upsert_null_and_repeated_ids")
def upsert_null_and_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice: rows without id are rejected both times, of repeated ids the latest stays."""
    rows = fixtures.transactions(spark, sf_dir)
    nameless = rows.withColumn("transaction_id", F.when(F.col("channel") != "atm", F.col("transaction_id")))
    later = rows.filter("entry_mode = 'magnetic' AND channel <> 'atm'").withColumns(
        {"amount": F.col("amount") + 1000, "timestamp": F.timestamp_micros(F.unix_micros("timestamp") + 1)})
    store = _store(spark, "layers")
    for _ in range(2):
        store.append_new("raw", later.unionByName(nameless))
    stored = store.read("raw").select(F.lit("raw").alias("layer"), "transaction_id", _rounded("amount", 2))
    rejected = store.read_rejected().select(
        F.lit("rejected").alias("layer"), F.lit(None).cast("string").alias("transaction_id"),
        F.round(F.get_json_object("line", "$.amount").cast("double"), 2).alias("amount"))
    return stored.unionByName(rejected)


@query("stream_session_stats")
def stream_session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with a checkpoint of their own each, one micro-batch each."""
    store = _streamed(spark, sf_dir, [~_later(), _later()], own_folders=True)
    rules = jobs.session_rule_counts(spark, store).agg(F.sum("times_triggered").alias("rules_fired"))
    return jobs.session_stats(spark, store).crossJoin(rules)


@query("stream_reprocess_idempotent")
def stream_reprocess_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines delivered twice: layers keep one copy, the audit log two of different
    queries; the first query's events written once more are one again when read as distinct."""
    store = _streamed(spark, sf_dir, [F.lit(True)], runs=2)
    first = store.read_audit().agg(F.min("query_id")).first()[0]
    again = Scratch(spark)
    store.append_audit(again.stage(store.read_audit().filter(F.col("query_id") == first), "audit"))
    again.release()
    layers = {name: store.read(name) for name in ("raw", "enriched", "alerts")}
    layers["audit"] = store.read_audit()
    layers["audit_distinct"] = distinct_events(store.read_audit())
    counts = [
        table.agg(
            F.lit(name).alias("layer"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("transaction_id").alias("ids"),
        )
        for name, table in layers.items()
    ]
    # Table after table, so that the ids of one at a time are on disk.
    with freed_shuffles(spark):
        counts = [Scratch(spark).stage(count, "counts") for count in counts]
    return reduce(DataFrame.union, counts)
