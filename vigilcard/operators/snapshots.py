"""What older history still contributes, in compact form.

Windows reach back 90 days at most, but the row before and the novelty flags reach back to
the first row ever stored. A snapshot as of a day holds, for all rows before that day, the
last row per card, the last row per BIN and the distinct values seen per card. With it a
batch reads only history from the snapshot day on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilcard.operators.novelty import seen_values
from vigilcard.operators.seconds import BIN_PAYLOAD, CARD_PAYLOAD


@dataclass(frozen=True)
class Snapshot:
    """Tables as of ``as_of``, the first second (a day border) that is not part of them."""

    as_of: int
    last_card: DataFrame
    last_bin: DataFrame
    seen: DataFrame

    TABLES = ("last_card", "last_bin", "seen")


def with_rows(snapshot: Snapshot, rows: DataFrame) -> Snapshot:
    """The snapshot with those of the aligned rows that lie before it as possible last rows."""
    old = rows.filter(F.col("ts_epoch") < snapshot.as_of)
    return Snapshot(
        snapshot.as_of,
        snapshot.last_card.unionByName(old.select(*snapshot.last_card.columns)),
        snapshot.last_bin.unionByName(old.select(*snapshot.last_bin.columns)),
        snapshot.seen,
    )


def last_rows(rows: DataFrame, key: str, payload: tuple[str, ...]) -> DataFrame:
    """The last row per key in (second, id) order; combined on the map side."""
    latest = F.expr(f"max(struct(ts_epoch, {', '.join(payload)})) AS latest")
    timed = rows.filter("ts_epoch IS NOT NULL").groupBy(key).agg(latest)
    return timed.select(key, "latest.*")


def snapshot_of(rows: DataFrame, as_of: int, base: Snapshot | None = None) -> Snapshot:
    """Snapshot of aligned rows, on top of an earlier snapshot when there is one."""
    cards = rows.select("card_key", "ts_epoch", *CARD_PAYLOAD)
    bins = rows.select("bin", "ts_epoch", *BIN_PAYLOAD)
    seen = seen_values(rows)
    if base is not None:
        cards = cards.unionByName(base.last_card)
        bins = bins.unionByName(base.last_bin)
        seen = seen.unionByName(base.seen).distinct()
    return Snapshot(
        as_of, last_rows(cards, "card_key", CARD_PAYLOAD), last_rows(bins, "bin", BIN_PAYLOAD), seen
    )
