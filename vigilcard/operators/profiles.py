"""Latest known state per card.

A profile column holds the last value that was present, so a row without a device does not
erase the device before it. ``max_by`` with a filter is a partial aggregate: a hot card is
reduced on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilcard.schemas import PROFILE

_SOURCES = {
    "customer_id": "customer_id",
    "last_timestamp": "timestamp",
    "last_city": "merchant_city",
    "last_terminal": "terminal_id",
    "last_device": "device_id",
    "last_amount": "amount",
    "risk_score": "risk_score",
    "risk_level": "risk_level",
}


def _latest(column: str, order: str, name: str) -> Column:
    return F.expr(f"max_by({column}, {order}) FILTER (WHERE {column} IS NOT NULL) AS {name}")


def card_profiles(enriched: DataFrame, updated_at: Column) -> DataFrame:
    """One row per card: its last present values in time order."""
    order = "struct(timestamp, transaction_id)"
    latest = (
        enriched.filter("card_id IS NOT NULL")
        .groupBy("card_id")
        .agg(*[_latest(column, order, name) for name, column in _SOURCES.items()])
    )
    known = {name: F.coalesce(F.col(name), F.lit(0.0)) for name in ("last_amount", "risk_score")}
    return latest.withColumns({**known, "updated_at": updated_at}).select(*PROFILE.names)


def merge_profiles(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new profiles as one: the later one wins per column where it has a value."""
    return merge_deltas([(0, stored), (1, new)])


def merge_deltas(deltas: list[tuple[int, DataFrame]]) -> DataFrame:
    """Profiles of several batches, numbered in their order, as one."""
    tagged = None
    for number, profiles in deltas:
        part = profiles.select(*PROFILE.names).withColumn("_new", F.lit(number).cast("long"))
        tagged = part if tagged is None else tagged.unionByName(part)
    order = "struct(last_timestamp, _new)"
    columns = [name for name in PROFILE.names if name != "card_id"]
    merged = tagged.groupBy("card_id").agg(*[_latest(name, order, name) for name in columns])
    return merged.select(*PROFILE.names)
