"""Bulk replay: recompute decisions of any set of stored transactions and compare."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilcard.config import EngineConfig
from vigilcard.operators.align import KEYS, align, day_literal
from vigilcard.operators.decisions import enriched_transactions, timestamp_literal, with_decision
from vigilcard.operators.novelty import with_novelty_as_of
from vigilcard.operators.replay import compare_decisions
from vigilcard.operators.seconds import NINETY_DAYS, with_windows
from vigilcard.plans.scoring import with_row_features
from vigilcard.sources.scratch import Scratch

# So many ids are few enough to broadcast them and their keys.
FEW_IDS = 100_000
# A second later than all.
ALWAYS = 2**62


def recompute_decisions(
    raw: DataFrame, config: EngineConfig, decision_ts: datetime, ids: DataFrame | None = None
) -> DataFrame:
    """Enriched rows of the given ids (all rows without ids), each against its own past.

    Up to ``FEW_IDS`` ids are looked up first; then only rows of their cards, customers and BINs
    up to the latest time asked of each are read for the windows, which no other row can enter. The
    ids, their times and keys, and the rows that are read are staged once, as every window and flag
    reads them; they stay in the scratch folder, as the result is lazy.
    """
    rows, rest = align(raw).drop("dt"), None
    everything = rows
    if ids is not None:
        scratch = Scratch(raw.sparkSession)
        wanted = scratch.stage(ids.select("transaction_id").distinct(), "replay-ids")
        if wanted.count() <= FEW_IDS:
            # Raw is searched for the ids once; times and keys are taken from what was found.
            found = rows.join(F.broadcast(wanted), "transaction_id", "left_semi")
            everything = _related(raw, scratch.stage(found.select("ts_epoch", *KEYS), "replay-asked"))
        marked = everything.join(wanted.withColumn("is_batch", F.lit(True)), "transaction_id", "left")
        marked = marked.withColumn("is_batch", F.coalesce("is_batch", F.lit(False)))
        everything = scratch.stage(marked, "replay-rows", "is_batch")
        rows, rest = everything.filter("is_batch"), everything.filter("NOT is_batch")
    rows = rows.withColumn("is_batch", F.lit(True))
    timed = with_windows(rows, rest, None, config.bin_window_seconds, as_of=everything)
    known = with_novelty_as_of(timed, rows, everything)
    features = with_row_features(known, config)
    return enriched_transactions(with_decision(features, config, timestamp_literal(decision_ts)))


def _related(raw: DataFrame, asked: DataFrame) -> DataFrame:
    """Aligned rows that share a card, customer or BIN with the asked rows, up to the latest time
    that is asked of that very key; rows that share the customer alone from 90 days before the
    customer's earliest time on, as the row before and the values seen belong to cards and BINs.
    Rows without a time stay, and so do all rows of a key that is asked without a time."""
    latest, untimed = asked.agg(F.max("ts_epoch"), F.count_if(F.col("ts_epoch").isNull())).first()
    if latest is not None and not untimed:
        if "dt" in raw.columns:
            raw = raw.filter(F.col("dt").isNull() | (F.col("dt") <= day_literal(latest)))
        raw = raw.filter(F.col("timestamp").isNull() | (F.col("timestamp") < F.timestamp_seconds(F.lit(latest + 1))))
    rows, second = align(raw).drop("dt"), F.col("ts_epoch")
    met = F.lit(False)
    for key in KEYS:
        timeless = F.count_if(second.isNull()) > 0
        bounds = asked.groupBy(key).agg(
            F.when(timeless, ALWAYS).otherwise(F.max("ts_epoch")).alias(f"_{key}_to"),
            F.when(timeless, -ALWAYS).otherwise(F.min("ts_epoch") - NINETY_DAYS).alias(f"_{key}_from"))
        rows = rows.join(F.broadcast(bounds), key, "left")  # a row per asked key, FEW_IDS at most
        reached = second <= F.col(f"_{key}_to")
        if key == "customer_key":
            reached = reached & (second >= F.col(f"_{key}_from"))
        met = met | (F.col(f"_{key}_to").isNotNull() & F.coalesce(reached, F.lit(True)))
    return rows.filter(met).drop(*[f"_{key}_{end}" for key in KEYS for end in ("from", "to")])


def verify_replay(
    raw: DataFrame,
    enriched: DataFrame,
    config: EngineConfig,
    decision_ts: datetime,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Compares stored with recomputed decisions; ids without records are reported, not dropped."""
    wanted = enriched.select("transaction_id") if ids is None else ids
    stored = enriched if ids is None else enriched.join(ids.select("transaction_id").distinct(), "transaction_id", "left_semi")
    return compare_decisions(wanted, stored, recompute_decisions(raw, config, decision_ts, ids))
