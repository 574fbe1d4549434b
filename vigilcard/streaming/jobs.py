"""The micro-batch job: every batch goes through the same code as a backfill."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilcard.config import EngineConfig
from vigilcard.operators.decisions import batch_stats
from vigilcard.plans.batch import process_batch
from vigilcard.sources.layers import DATED, LayerStore


def start_scoring(
    rows: DataFrame,
    store: LayerStore,
    config: EngineConfig,
    checkpoint: str | None = None,
    available_now: bool = False,
    decision_ts: datetime | None = None,
    keep_snapshots: bool = True,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Starts scoring a stream of raw transactions into the layers.

    A micro-batch may be delivered again after a failure. The layers keep their first copy
    of a transaction, and statistics are stored per query and epoch, so a second delivery
    changes neither; the audit log and the rejected layer record both, with query and epoch.

    With ``compact_every`` the dates of the transaction layers are compacted once in so many
    epochs; of the streams into one store only one may do that.
    """
    location = checkpoint or config.streaming.checkpoint_dir
    if not location:
        raise ValueError("a stream needs a checkpoint folder")

    def score(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        local = LayerStore(batch.sparkSession, store.root)
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        result = process_batch(batch, local, config, decision_ts, run=(query_id, epoch), keep_snapshots=keep_snapshots)
        try:
            write_epoch_stats(result.enriched, local, epoch, query_id)
        finally:
            result.release()
        if compact_every and epoch % compact_every == compact_every - 1:
            for layer in DATED:
                local.compact(layer)

    writer = rows.writeStream.foreachBatch(score).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{config.streaming.processing_time_seconds} seconds")
    return writer.start()


def write_epoch_stats(enriched: DataFrame, store: LayerStore, epoch: int, query_id: str | None = None) -> None:
    """Statistics of one micro-batch; an epoch of a query that comes again replaces its own
    figures, and those of another query or checkpoint stand beside them."""
    levels = batch_stats(enriched).drop("avg_score")
    scores = enriched.agg(F.coalesce(F.sum("risk_score"), F.lit(0.0)).alias("score_sum"))
    rules = enriched.select(F.explode("triggered_rules").alias("rule_name")).groupBy("rule_name").count()
    counts = rules.agg(F.map_from_entries(F.collect_list(F.struct("rule_name", "count"))).alias("rule_counts"))
    row = levels.crossJoin(scores).crossJoin(counts)
    folder = f"{store.path('stream_stats')}/query={query_id or 'none'}/epoch={epoch}"
    row.coalesce(1).write.mode("overwrite").parquet(folder)


def session_stats(spark: SparkSession, store: LayerStore) -> DataFrame | None:
    """Totals over all epochs, one row; None before the first epoch."""
    epochs = _epochs(spark, store)
    if epochs is None:
        return None
    totals = [F.sum(name).alias(name) for name in ("processed", "alerts", "approve", "review", "block")]
    average = F.round(F.coalesce(F.try_divide(F.sum("score_sum"), F.sum("processed")), F.lit(0.0)), 2)
    return epochs.agg(*totals, average.alias("avg_score"))


def session_rule_counts(spark: SparkSession, store: LayerStore) -> DataFrame | None:
    """How often each rule fired over all epochs; None before the first epoch."""
    epochs = _epochs(spark, store)
    if epochs is None:
        return None
    entries = epochs.select(F.explode("rule_counts").alias("rule_name", "n"))
    return entries.groupBy("rule_name").agg(F.sum("n").alias("times_triggered"))


def _epochs(spark: SparkSession, store: LayerStore) -> DataFrame | None:
    try:
        return spark.read.parquet(store.path("stream_stats"))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
