"""Batch processing: score a batch against the stored layers and persist the results."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.config import EngineConfig
from vigilcard.operators import decisions
from vigilcard.operators.align import since_seconds
from vigilcard.operators.profiles import card_profiles
from vigilcard.operators.seconds import ONE_DAY
from vigilcard.plans.scoring import score_transactions
from vigilcard.schemas import RAW
from vigilcard.sources.layers import LayerStore, has_repeated_ids, one_per_id
from vigilcard.sources.scratch import Scratch, freed_shuffles

# A batch of at most this many rows has few enough keys to broadcast them; the windows of a larger
# one are staged family by family.
BROADCAST_KEYS = 200_000
# Days of a batch up to which stored moments of days save reading.
MOMENT_DAYS = 40


@dataclass
class BatchResult:
    """Tables of one processed batch; they stay readable until :meth:`release`."""

    enriched: DataFrame
    alerts: DataFrame
    scratch: Scratch

    def stats(self) -> DataFrame:
        """Counts per decision and average score, one row."""
        return decisions.batch_stats(self.enriched)

    def rule_counts(self) -> DataFrame:
        """Fired rules with their counts."""
        return decisions.rule_trigger_counts(self.enriched)

    def release(self) -> None:
        """Removes the staged tables behind the result."""
        self.scratch.release()


def process_batch(
    batch: DataFrame,
    store: LayerStore,
    config: EngineConfig,
    decision_ts: datetime | None = None,
    write: bool = True,
    run: tuple[str | None, int | None] = (None, None),
    keep_snapshots: bool = False,
    keep_moments: bool = False,
) -> BatchResult:
    """Scores a batch against stored history and appends to every layer.

    What came and its scores are staged once; every layer is then written from the staged
    tables, so no step parses again or recomputes the windows. Of rows that share an id the latest counts, see
    ``one_per_id``; rows without an id, and lines that a stream could not parse, go to the
    rejected layer. ``run`` is the query and epoch of a micro-batch, for the audit log.

    All layers become visible in one step, see ``LayerStore.batch``: a batch that is killed on the
    way is absent, and a stream takes its remains back when the batch is delivered again.

    With ``keep_snapshots`` the history snapshot is renewed at day borders, so that later
    batches read little history. Rows too old for the newest snapshot are scored in a part of
    their own and do not widen what the rest reads; no decision depends on either.

    With ``keep_moments``, on from the first batch of a store, the moments of each customer's days
    are kept, and the spending profile reads raw for two days of each day of the batch in place
    of 91. Batches with ids that are stored, late rows or more than ``MOMENT_DAYS`` days read raw.
    """
    scratch = Scratch(store.spark)
    if write and run[0]:
        store.roll_back(run[0])  # what an earlier, killed delivery has left
    try:
        with freed_shuffles(store.spark):
            return _process(batch, store, config, decision_ts, write, run, keep_snapshots, keep_moments, scratch)
    except BaseException:
        scratch.release()
        raise


def _process(
    batch: DataFrame,
    store: LayerStore,
    config: EngineConfig,
    decision_ts: datetime | None,
    write: bool,
    run: tuple[str | None, int | None],
    keep_snapshots: bool,
    keep_moments: bool,
    scratch: Scratch,
) -> BatchResult:
    moment = decision_ts or datetime.now(timezone.utc)
    now = decisions.timestamp_literal(moment)
    # What came is read once: it may be text to parse. Whole rows are grouped only if ids repeat.
    lines = [c for c in batch.columns if c == "rejected_line"]
    came = scratch.stage(batch.select(*RAW.names, *lines), "came")
    rows = came.filter("transaction_id IS NOT NULL").select(*RAW.names)
    if has_repeated_ids(rows):
        rows = scratch.stage(one_per_id(rows), "batch")
    second = F.unix_timestamp("timestamp")
    since, until, count, untimed = rows.agg(
        F.min(second), F.max(second), F.count(F.lit(1)), F.count_if(F.col("timestamp").isNull())
    ).first()

    history = store.read("raw")
    stored_ids = None
    # Raw is written first: an id that it lacks is in no other layer, so a batch without
    # repeated ids looks ids up once.
    fresh = history is None and store.read("enriched") is None
    if history is not None:
        stored_ids = scratch.stage(store.ids_already_in("raw", rows), "stored-ids")
        fresh = stored_ids.isEmpty()
        if not fresh:
            history = history.join(stored_ids, "transaction_id", "left_anti")
    few_keys = count <= BROADCAST_KEYS
    border = _late_border(store, since, until) if history is not None else None
    moments, days = None, None
    if keep_moments and fresh and history is not None and border is None and since is not None:
        if until // ONE_DAY - since // ONE_DAY < MOMENT_DAYS:
            moments, days = store.read_day_moments(), list(range(since // ONE_DAY, until // ONE_DAY + 1))

    def score(part: DataFrame, begin: int | None, companions: DataFrame | None = None) -> DataFrame:
        ended, snapshot = False, None
        if history is not None and begin is not None:
            ended = since_seconds(history, begin).isEmpty()
            snapshot = store.snapshot_before(begin - ONE_DAY)
        return score_transactions(
            part, history, config, moment, begin, ended, snapshot, few_keys, companions, moments, days,
            None if few_keys else scratch.stage)

    if border is None:
        scored = scratch.stage(score(rows, since), "scored")
    else:
        late = rows.filter(F.col("timestamp") < F.timestamp_seconds(F.lit(border)))
        rest = rows.filter(F.col("timestamp").isNull() | (F.col("timestamp") >= F.timestamp_seconds(F.lit(border))))
        # One after the other, so that the shuffles of both are never on disk together.
        early = scratch.stage(score(late, since), "scored")
        scored = early.unionByName(scratch.stage(score(rest, border, late), "scored"))
    enriched = decisions.enriched_transactions(scored)
    alerts = decisions.alerts(scored)
    if write:
        without_id = came.filter("transaction_id IS NULL")
        with store.batch(run[0] or "none"):
            store.append_rejected(without_id, "no transaction id", *run)
            store.append_new("raw", rows, stored_ids, unique=True, fresh=fresh)
            store.add_late_rows(rows, None if untimed else since)
            if keep_moments:
                store.write_day_moments(rows if fresh else rows.join(stored_ids, "transaction_id", "left_anti"))
            store.append_new("enriched", enriched, unique=True, fresh=fresh)
            store.append_new("alerts", alerts, unique=True, fresh=fresh)
            store.append_audit(decisions.audit_events(enriched, now, *run))
            store.write_profiles(card_profiles(enriched, now))
        if keep_snapshots and until is not None:
            # A clock that is ahead must not take a snapshot of days still to come.
            store.maintain_snapshot(min(until, int(moment.replace(tzinfo=moment.tzinfo or timezone.utc).timestamp())))
    return BatchResult(enriched, alerts, scratch)


def _late_border(store: LayerStore, since: int | None, until: int | None) -> int | None:
    """The first second of a batch that its newest usable snapshot serves, if earlier rows of
    the batch prevent its use; else None."""
    newest = None if since is None else store.snapshot_before(until - ONE_DAY)
    return newest.as_of + ONE_DAY if newest is not None and newest.as_of > since - ONE_DAY else None


def backfill(
    spark: SparkSession,
    source: str,
    store: LayerStore,
    config: EngineConfig,
    limit: int = 0,
    decision_ts: datetime | None = None,
    write: bool = True,
) -> BatchResult:
    """Processes Parquet transactions as one batch; ``limit`` keeps the first rows in time order."""
    rows = first_transactions(spark.read.parquet(source), limit)
    return process_batch(rows, store, config, decision_ts, write)


def first_transactions(rows: DataFrame, limit: int = 0) -> DataFrame:
    """The first ``limit`` rows by time and id; all rows when ``limit`` is 0.

    Counts per day, then per second of one day, find the second in which the limit falls, so
    that only rows of that second are put in order; rows without a time come first.
    """
    if limit <= 0:
        return rows
    second = F.unix_seconds("timestamp")
    day = F.floor(second / 86400)
    before_day, limit = _reached(rows, day, limit)
    if before_day is None:
        return rows
    in_day = rows.filter(day.eqNullSafe(F.lit(before_day[0])))
    before_second, limit = _reached(in_day, second, limit)
    earlier = rows.filter(before_day[1](day) | (day.eqNullSafe(F.lit(before_day[0])) & before_second[1](second)))
    last = in_day.filter(second.eqNullSafe(F.lit(before_second[0])))
    return earlier.unionByName(last.orderBy("timestamp", "transaction_id").limit(limit))


def _reached(rows: DataFrame, unit: Column, limit: int) -> tuple[tuple | None, int]:
    """The unit of time in which ``limit`` rows are reached, as (unit, condition for earlier
    ones), and how many of its rows are needed; None when there are fewer rows."""
    counts = rows.groupBy(unit.alias("unit")).count().orderBy(F.asc_nulls_first("unit")).collect()
    for unit_, n in counts:
        if n >= limit:
            none = F.lit(False)
            return (unit_, (lambda c: none) if unit_ is None else (lambda c: c.isNull() | (c < unit_))), limit
        limit -= n
    return None, limit
