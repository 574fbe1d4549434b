"""First-seen flags of terminals, devices and cities, and chip-only cards.

The values seen per card grow without bound, so they are never broadcast by hint. One scan
of history yields the distinct (card, kind, value) set, combined on the map side; one narrow
semi-join probes it for all four flags; and the flags meet the wide rows on the unique
transaction id, where no key can be hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entry modes that count as chip use.
CHIP_MODES = ("chip", "contactless")
NON_CHIP_USE = "entry_mode NOT IN ({})".format(", ".join(f"'{mode}'" for mode in CHIP_MODES))

TERMINAL, DEVICE, CITY, NON_CHIP = 1, 2, 3, 4
_FLAGS = {"new_terminal": TERMINAL, "new_device": DEVICE, "new_city": CITY}


def _tagged(df: DataFrame, extra: list[str], non_chip: str) -> DataFrame:
    """One row per (card, kind, value) a transaction carries; null values are left out."""
    marker = f"CASE WHEN {non_chip} THEN '' END"
    pairs = f"{TERMINAL}, terminal_id, {DEVICE}, device_id, {CITY}, merchant_city, {NON_CHIP}, {marker}"
    tagged = df.selectExpr(*extra, "card_id", f"stack(4, {pairs}) AS (kind, value)")
    return tagged.filter("card_id IS NOT NULL AND value IS NOT NULL")


def seen_values(history: DataFrame) -> DataFrame:
    """Distinct (card_id, kind, value) of history; kind 4 marks cards with non-chip use."""
    return _tagged(history, [], NON_CHIP_USE).distinct()


def with_novelty(batch: DataFrame, probed: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Adds ``new_terminal``, ``new_device``, ``new_city`` and ``entry_mode_chip_only_history``.

    ``probed`` holds the raw columns of the same rows; probing it instead of ``batch`` keeps
    the features already attached out of the probe. Without any history (``seen`` is None)
    everything is new and no card counts as chip-only. With history, even an empty one, a
    card nobody has seen is chip-only. Transaction ids must be unique within the batch.
    """
    if seen is None:
        flags = {name: F.lit(True) for name in _FLAGS}
        return batch.withColumns({**flags, "entry_mode_chip_only_history": F.lit(False)})
    probes = _tagged(probed, ["transaction_id"], "true")
    return _with_met_kinds(batch, probes.join(seen, ["card_id", "kind", "value"], "left_semi"))


def with_novelty_as_of(rows: DataFrame, probed: DataFrame, everything: DataFrame) -> DataFrame:
    """Novelty of rows against all other rows of ``everything`` up to their own time.

    A value was met before when its first use is earlier, or when it is simultaneous and
    more than one row has it.
    """
    uses = _tagged(everything, ["timestamp"], NON_CHIP_USE)
    per_time = uses.groupBy("card_id", "kind", "value", "timestamp").agg(F.count(F.lit(1)).alias("uses"))
    first = per_time.groupBy("card_id", "kind", "value").agg(F.min(F.struct("timestamp", "uses")).alias("first"))
    probes = _tagged(probed, ["transaction_id", "timestamp", f"coalesce({NON_CHIP_USE}, false) AS own_use"], "true")
    # The row itself is one of the uses, except for a chip row probing for non-chip use.
    itself = f"CASE WHEN kind <> {NON_CHIP} OR own_use THEN 1 ELSE 0 END"
    met = probes.join(first, ["card_id", "kind", "value"]).filter(
        f"first.timestamp < timestamp OR (first.timestamp = timestamp AND first.uses > {itself})"
    )
    return _with_met_kinds(rows, met)


def _with_met_kinds(rows: DataFrame, met: DataFrame) -> DataFrame:
    kinds = {**_FLAGS, "entry_mode_chip_only_history": NON_CHIP}
    flags = met.groupBy("transaction_id").agg(
        *[F.expr(f"bool_or(kind = {kind}) AS met_{kind}") for kind in kinds.values()]
    )
    columns = [f"`{c}`" for c in rows.columns]
    new = [f"NOT coalesce(met_{kind}, false) AS {name}" for name, kind in kinds.items()]
    return rows.join(flags, "transaction_id", "left").selectExpr(*columns, *new)
