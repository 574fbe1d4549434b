"""Fixed, explicit schemas of every table the engine reads or writes."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STRING, _DOUBLE, _LONG, _BOOL, _TS = StringType(), DoubleType(), LongType(), BooleanType(), TimestampType()
_STRINGS = ArrayType(StringType())


def _schema(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Table layouts (column names, order and types).
RAW = _schema(
    ("transaction_id", _STRING),
    ("customer_id", _STRING),
    ("card_id", _STRING),
    ("timestamp", _TS),
    ("amount", _DOUBLE),
    ("currency", _STRING),
    ("merchant_id", _STRING),
    ("merchant_category", _STRING),
    ("merchant_city", _STRING),
    ("merchant_country", _STRING),
    ("terminal_id", _STRING),
    ("entry_mode", _STRING),
    ("device_id", _STRING),
    ("channel", _STRING),
    ("auth_result", _STRING),
)

FEATURES = _schema(
    ("velocity_1min", _LONG),
    ("velocity_5min", _LONG),
    ("velocity_1h", _LONG),
    ("velocity_24h", _LONG),
    ("count_10min", _LONG),
    ("sum_10min", _DOUBLE),
    ("min_10min", _DOUBLE),
    ("amount_zscore", _DOUBLE),
    ("amount_vs_avg_ratio", _DOUBLE),
    ("distance_from_last_km", _DOUBLE),
    ("travel_speed_kmh", _DOUBLE),
    ("minutes_since_last", _DOUBLE),
    ("dormant_days", _DOUBLE),
    ("new_terminal", _BOOL),
    ("new_device", _BOOL),
    ("new_city", _BOOL),
    ("entry_mode_chip_only_history", _BOOL),
    ("high_risk_merchant", _BOOL),
    ("hour_of_day", _LONG),
    ("bin_denials_15min", _LONG),
    ("previous_transaction_id", _STRING),
)

DECISION = _schema(
    ("risk_score", _DOUBLE),
    ("risk_level", _STRING),
    ("triggered_rules", _STRINGS),
    ("rule_reasons", _STRINGS),
    ("decision_timestamp", _TS),
    ("model_version", _STRING),
)

ENRICHED = StructType(RAW.fields + FEATURES.fields + DECISION.fields)

ALERT = _schema(
    ("transaction_id", _STRING),
    ("customer_id", _STRING),
    ("card_id", _STRING),
    ("bin", _STRING),
    ("timestamp", _TS),
    ("amount", _DOUBLE),
    ("currency", _STRING),
    ("merchant_id", _STRING),
    ("merchant_category", _STRING),
    ("merchant_city", _STRING),
    ("merchant_country", _STRING),
    ("entry_mode", _STRING),
    ("channel", _STRING),
    ("risk_score", _DOUBLE),
    ("risk_level", _STRING),
    ("triggered_rules", _STRINGS),
    ("rule_reasons", _STRINGS),
    ("feature_snapshot", _STRING),
    ("decision_timestamp", _TS),
    ("model_version", _STRING),
)

PROFILE = _schema(
    ("card_id", _STRING),
    ("customer_id", _STRING),
    ("last_timestamp", _TS),
    ("last_city", _STRING),
    ("last_terminal", _STRING),
    ("last_device", _STRING),
    ("last_amount", _DOUBLE),
    ("risk_score", _DOUBLE),
    ("risk_level", _STRING),
    ("updated_at", _TS),
)

AUDIT = _schema(
    ("event", _STRING),
    ("transaction_id", _STRING),
    ("customer_id", _STRING),
    ("card_id", _STRING),
    ("timestamp", _STRING),
    ("amount", _DOUBLE),
    ("risk_score", _DOUBLE),
    ("risk_level", _STRING),
    ("triggered_rules", _STRINGS),
    ("rule_reasons", _STRINGS),
    ("model_version", _STRING),
    ("audit_ts", _STRING),
)

# What events carry beside the fixed columns: the run they belong to, and all of an alert.
AUDIT_RUN = _schema(("query_id", _STRING), ("epoch", _LONG))
AUDIT_READ = StructType(
    AUDIT.fields
    + [StructField(f.name, f.dataType if f.dataType != _TS else _STRING, True) for f in ALERT.fields if f.name not in AUDIT.names]
    + AUDIT_RUN.fields
)

REJECTED = _schema(("reason", _STRING), ("line", _STRING), ("query_id", _STRING), ("epoch", _LONG))

FRAUD_LABELS = _schema(("transaction_id", _STRING), ("is_fraud", _BOOL), ("fraud_type", _STRING))

# Feature keys kept, unrounded, in the JSON snapshot of an alert.
SNAPSHOT_FEATURES = (
    "velocity_1min",
    "velocity_5min",
    "velocity_1h",
    "velocity_24h",
    "count_10min",
    "sum_10min",
    "min_10min",
    "amount_mean_90d",
    "amount_count_90d",
    "prev_ts",
    "prev_merchant_city",
    "prev_terminal_id",
    "prev_device_id",
    "prev_amount",
    "prev_entry_mode",
    "previous_transaction_id",
    "bin_denials_15min",
    "prev_bin_approved",
    "new_terminal",
    "new_device",
    "new_city",
    "entry_mode_chip_only_history",
    "distance_from_last_km",
    "travel_speed_kmh",
    "minutes_since_last",
    "dormant_days",
    "amount_zscore",
    "amount_vs_avg_ratio",
    "hour_of_day",
    "high_risk_merchant",
)
