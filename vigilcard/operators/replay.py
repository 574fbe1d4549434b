"""Recomputing stored decisions in bulk and comparing them with what was stored.

A row is recomputed against its own past: rows with a smaller timestamp, and rows with the
same timestamp and another id. Range frames only look at earlier whole seconds, so they are
the ordinary windows over all rows. Predecessors and novelty need care inside a second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_second_predecessors(rows: DataFrame, key: str, payload: tuple[str, ...]) -> DataFrame:
    """Predecessors in seconds where ids and times disagree.

    Returns ``(transaction_id, repaired)`` for the rows whose neighbour by id in the same
    (key, second) happened later: ``repaired`` is the row with the greatest smaller id that
    happened no later, or null. The search runs over binary prefixes of the microsecond:
    "no later than m" is a union of at most 20 aligned ranges, one per set bit of m, and in
    each of them the answer is a running maximum. No pairs of rows are formed.
    """
    struct = f"struct(ts_epoch, {', '.join(payload)})"
    by_id = f"PARTITION BY {key}, ts_epoch ORDER BY transaction_id"
    checked = rows.filter("ts_epoch IS NOT NULL").selectExpr(
        key,
        "ts_epoch",
        "transaction_id",
        "unix_micros(timestamp) - ts_epoch * 1000000 AS micros",
        f"{struct} AS entry",
        f"coalesce(lag(timestamp) OVER ({by_id}) > timestamp, false) AS disordered",
    )
    mixed = checked.selectExpr("*", f"bool_or(disordered) OVER (PARTITION BY {key}, ts_epoch) AS mixed")
    # Level -1 pairs equal microseconds; level b pairs a set bit b with the same prefix and b unset.
    leveled = mixed.filter("mixed").selectExpr("*", "explode(sequence(-1, 19)) AS level")
    ranged = leveled.selectExpr(
        "*",
        "CASE WHEN level < 0 THEN micros ELSE shiftright(micros, level + 1) END AS prefix",
        "level < 0 OR shiftright(micros, greatest(level, 0)) % 2 = 0 AS offers",
        "level < 0 OR shiftright(micros, greatest(level, 0)) % 2 = 1 AS asks",
    )
    scope = f"PARTITION BY {key}, ts_epoch, level, prefix ORDER BY transaction_id"
    found = ranged.selectExpr(
        "transaction_id",
        "disordered",
        f"CASE WHEN asks THEN max(CASE WHEN offers THEN entry END) OVER "
        f"({scope} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS candidate",
    )
    return found.filter("disordered").groupBy("transaction_id").agg(F.max("candidate").alias("repaired"))


def compare_decisions(ids: DataFrame, stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Verdict for every requested id: stored and recomputed decision, and what is missing."""
    wanted = ids.select("transaction_id").distinct()

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "transaction_id",
            F.col("risk_level").alias(f"{name}_level"),
            F.round(F.coalesce(F.col("risk_score"), F.lit(0.0)), 2).alias(f"{name}_score"),
            F.coalesce(F.col("triggered_rules"), F.array().cast("array<string>")).alias(f"{name}_rules"),
            F.lit(True).alias(f"_{name}"),
        )

    both = wanted.join(side(stored, "stored"), "transaction_id", "left").join(
        side(recomputed, "recomputed"), "transaction_id", "left"
    )
    same = F.col("stored_level").eqNullSafe(F.col("recomputed_level")) & F.col("stored_score").eqNullSafe(
        F.col("recomputed_score")
    )
    status = (
        F.when(F.col("_stored").isNull(), "not_in_enriched")
        .when(F.col("_recomputed").isNull(), "not_in_raw")
        .when(same, "idempotent")
        .otherwise("changed")
    )
    return both.select(
        "transaction_id",
        "stored_level",
        "recomputed_level",
        "stored_score",
        "recomputed_score",
        "stored_rules",
        "recomputed_rules",
        (status == "idempotent").alias("idempotent"),
        status.alias("status"),
    )
