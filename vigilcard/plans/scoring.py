"""The one core of batch, streaming and replay: transactions in, scored transactions out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilcard.config import EngineConfig
from vigilcard.functions import amounts, cards, geo
from vigilcard.operators.align import align, since_seconds
from vigilcard.operators.decisions import timestamp_literal, with_decision
from vigilcard.operators.novelty import seen_values, with_novelty
from vigilcard.operators.rules import FAMILIES, fired_entries, needed_families, with_conditions
from vigilcard.operators.seconds import with_windows
from vigilcard.operators.snapshots import Snapshot, with_rows


def with_row_features(
    df: DataFrame, config: EngineConfig, families: tuple[str, ...] = FAMILIES
) -> DataFrame:
    """Per-row features: elapsed time, distance, speed, dormancy, profile and merchant risk.

    Features derived from a window family are added only when that family is present.
    """
    added = {
        "hour_of_day": cards.hour_of_day(F.col("timestamp")),
        "high_risk_merchant": cards.high_risk_merchant(F.col("merchant_category"), config.high_risk_categories),
    }
    if "customer" in families:
        amount = F.coalesce(F.col("amount"), F.lit(0.0))
        mean, std = F.col("amount_mean_90d"), F.col("amount_std_90d")
        added["amount_zscore"] = amounts.zscore(amount, mean, std)
        added["amount_vs_avg_ratio"] = amounts.ratio_to_mean(amount, mean)
    if "card" not in families:
        return df.withColumns(added)
    added["minutes_since_last"] = cards.minutes_since(F.col("timestamp"), F.col("prev_ts"))
    added["dormant_days"] = cards.days_since(F.col("timestamp"), F.col("prev_ts"))
    placed = geo.with_city_distance(df, "prev_merchant_city", "merchant_city", "distance_from_last_km")
    speed = geo.speed_kmh(F.col("distance_from_last_km"), F.col("minutes_since_last"))
    return placed.withColumns(added).withColumn("travel_speed_kmh", speed)


def transaction_features(
    batch: DataFrame,
    history: DataFrame | None,
    config: EngineConfig,
    since: int | None = None,
    history_ended: bool = False,
    families: tuple[str, ...] = FAMILIES,
    snapshot: Snapshot | None = None,
    few_keys: bool = False,
    companions: DataFrame | None = None,
    moments: DataFrame | None = None,
    days: list[int] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Batch rows with every unrounded feature of the chosen families.

    ``history`` None means that no history exists at all; an empty DataFrame means that it
    exists and holds nothing, which the novelty flags tell apart. History must not hold ids
    of the batch (``without_ids_of`` removes them): it is read by every window family, so
    that step belongs before this one. ``since`` is a lower bound, in epoch seconds, of the
    batch time; ``history_ended`` promises that history ends before the batch begins. A
    ``snapshot`` replaces history before its day where only its last or distinct values
    matter. ``few_keys`` allows to broadcast the keys of the batch. ``companions`` are rows of
    the same batch, all before ``since``, that are scored elsewhere: windows see them,
    novelty does not. ``moments`` and ``days`` shorten what the spending profile reads, see
    ``customer_seconds``. ``keep`` stores the windows of each family, see ``with_windows``.
    """
    rows = align(batch).withColumn("is_batch", F.lit(True))
    past = None if history is None else align(history).withColumn("is_batch", F.lit(False))
    before, known = past, snapshot
    if companions is not None:
        beside = align(companions).withColumn("is_batch", F.lit(False))
        if past is not None and "dt" in past.columns:
            beside = beside.withColumn("dt", cards.utc_date(F.col("timestamp")))
        before = beside if past is None else past.unionByName(beside)
        known = None if snapshot is None else with_rows(snapshot, beside)
    featured = with_windows(
        rows, before, since, config.bin_window_seconds, history_ended, families, snapshot=known, few_keys=few_keys,
        moments=moments, days=days, keep=keep,
    )
    if "novelty" in families:
        featured = with_novelty(featured, rows, _seen(past, rows, snapshot, few_keys))
    featured = with_row_features(featured, config, families)
    return featured.drop("ts_epoch", "card_key", "customer_key", "bin", "is_batch")


def _seen(
    past: DataFrame | None, rows: DataFrame, snapshot: Snapshot | None, few_keys: bool
) -> DataFrame | None:
    if past is None:
        return None
    mine = F.broadcast(rows.select("card_id").distinct())
    recent = past if snapshot is None else since_seconds(past, snapshot.as_of)
    if few_keys:
        recent = recent.join(mine, "card_id", "left_semi")
    seen = seen_values(recent)
    if snapshot is None:
        return seen
    older = snapshot.seen.join(mine, "card_id", "left_semi") if few_keys else snapshot.seen
    return seen.unionByName(older)


def score_transactions(
    batch: DataFrame,
    history: DataFrame | None,
    config: EngineConfig,
    decision_ts: datetime | None = None,
    since: int | None = None,
    history_ended: bool = False,
    snapshot: Snapshot | None = None,
    few_keys: bool = False,
    companions: DataFrame | None = None,
    moments: DataFrame | None = None,
    days: list[int] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Features and decisions of a batch, unrounded and, but for what ``keep`` stores, lazy.

    Transaction ids must be unique within the batch; ``process_batch`` takes care of that.
    """
    moment = decision_ts or datetime.now(timezone.utc)
    features = transaction_features(
        batch, history, config, since, history_ended, snapshot=snapshot, few_keys=few_keys, companions=companions,
        moments=moments, days=days, keep=keep,
    )
    return with_decision(features, config, timestamp_literal(moment))


def rule_hits(
    batch: DataFrame,
    history: DataFrame | None,
    config: EngineConfig,
    since: int | None = None,
    history_ended: bool = False,
) -> DataFrame:
    """Rows on which an active rule fires, one per (transaction, rule), with weight and reason.

    Only the feature families the active rules read are computed.
    """
    families = needed_families(config)
    features = transaction_features(batch, history, config, since, history_ended, families)
    judged, flags = with_conditions(features, config)
    return judged.select("transaction_id", F.inline(fired_entries(flags))).filter("rule_name IS NOT NULL")
