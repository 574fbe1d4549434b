"""Sliding windows and predecessors per card, customer and BIN.

Every frame of the model is ``[t - N, t - 1]`` in whole seconds, so all rows of one key in
one second share the same window values. That allows a plan that stays within bounds when a
single key holds a large part of the data:

1. rows are aggregated to one row per (key, second); the map side combines, so a hot key
   shrinks before it is shuffled and a key never has more rows than its life has seconds;
2. a key's time line is cut into slots, and each slot receives copies of the seconds its
   frames reach back to. A frame group is (key, slot): at most two slots of seconds, however
   many transactions they stand for;
3. counts are differences of two running totals, which whole numbers allow. A frame exactly
   as long as a slot (90 days) of other numbers is the running total of its own slot plus the
   running total, read backwards, of the slot before. All are running frames of linear cost;
4. the row before may lie any time back. It is the last row of an earlier second of the slot
   or, for the first second of a slot, of a carried row: the last second of the key's
   previous used slot, found in a table of one row per (key, slot).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilcard.operators.align import day_literal, since_seconds
from vigilcard.operators.replay import in_second_predecessors

# Window lengths in seconds.
ONE_MINUTE, FIVE_MINUTES, TEN_MINUTES, ONE_HOUR, ONE_DAY = 60, 300, 600, 3600, 86400
NINETY_DAYS = 90 * ONE_DAY
# A card's slot: most cards have few rows a day, and every group costs something.
CARD_SLOT = 8 * ONE_DAY

# Columns of the row before, behind its second; the id decides the order inside a second.
CARD_PAYLOAD = (
    "transaction_id",
    "timestamp",
    "merchant_city",
    "terminal_id",
    "device_id",
    "amount",
    "entry_mode",
)
BIN_PAYLOAD = ("transaction_id", "timestamp", "auth_result")

# One id in so many, by its hash, may be a border between ranges of ids of a crowded second,
# and the most borders a second has.
BORDER_RATE, MOST_BORDERS = 4096, 255

_EPOCH = date(1970, 1, 1).toordinal()
# Parts a second plays in a slot.
OWN, REACHED, CARRIED = "own", "reached", "carried"


def _second_rows(
    batch: DataFrame,
    history: DataFrame | None,
    key: str,
    columns: tuple[str, ...],
    measures: dict[str, str],
    since: int | None,
    reach: int,
    keep_older: bool,
    older: DataFrame | None = None,
    from_second: int | None = None,
    few_keys: bool = False,
) -> DataFrame:
    """One row per (key, second) with the given aggregates; ``wanted`` marks batch seconds.

    With a known ``since``, history older than ``reach`` seconds before it is dropped, or,
    when the row before may lie there, collapsed to one row per key outside every frame.
    ``older`` stands for all history before ``from_second``. With ``few_keys`` the keys of
    the batch are known to be few, and history of other keys is dropped while it is scanned.
    """
    taken = [key, *columns, "ts_epoch", "is_batch"]
    rows = batch.select(*taken)
    if history is not None:
        if not keep_older:
            past = since_seconds(history, since, reach)
        else:
            past = since_seconds(history, from_second)
        past = past.select(*taken)
        if older is not None:
            past = past.unionByName(older.withColumn("is_batch", F.lit(False)).select(*taken))
        if few_keys:
            past = past.join(F.broadcast(batch.select(key).distinct()), key, "left_semi")
        rows = past.unionByName(rows)
    second = "ts_epoch"
    if keep_older and since is not None:
        second = f"greatest(ts_epoch, {since - reach - 1}L)"
    aggregates = [F.expr(f"{text} AS {name}") for name, text in measures.items()]
    return (
        rows.filter("ts_epoch IS NOT NULL")
        .groupBy(key, F.expr(f"{second} AS ts_epoch"))
        .agg(*aggregates, F.expr("bool_or(is_batch) AS wanted"))
    )


def _slot(length: int) -> str:
    return f"(ts_epoch - pmod(ts_epoch, {length})) div {length}"


def _in_slots(
    seconds: DataFrame, key: str, slot: int, reach: int, since: int | None, carry: bool = False, ahead: int = 1
) -> DataFrame:
    """Seconds in their own slot and, as ``reached``, in the next one (or the one ``ahead`` slots
    later) if a frame there needs them.

    ``countdown`` is the time left in the slot, the order in which a slot is read backwards.
    ``carry`` adds the last second of the previous used slot as ``carried``, without values.
    """
    near_end = "" if reach >= slot else f"WHEN pmod(ts_epoch, {slot}) < {slot - reach} THEN array(0)"
    hops = f"explode(CASE {near_end} WHEN true THEN array(0, {ahead}) END) AS hop"
    role = f"CASE WHEN hop = 0 THEN '{OWN}' ELSE '{REACHED}' END AS role"
    copies = seconds.selectExpr("*", hops).selectExpr("*", f"({_slot(slot)}) + hop AS slot", role).drop("hop")
    if since is not None:
        copies = copies.filter(F.col("slot") >= since // slot)
    if carry:
        copies = copies.unionByName(_carried(seconds, key, slot), allowMissingColumns=True)
    return copies.selectExpr("*", f"{slot - 1} - pmod(ts_epoch, {slot}) AS countdown")


def _carried(seconds: DataFrame, key: str, slot: int) -> DataFrame:
    """For each (key, slot) with batch rows, the last second of the key's previous used slot.

    The whole second is aggregated although only its last row is needed: with all columns in
    use, this branch and the main one share one scan and one shuffle of the seconds.
    """
    whole = ", ".join(seconds.columns)
    used = seconds.groupBy(key, F.expr(f"{_slot(slot)} AS slot")).agg(
        F.expr(f"max_by(struct({whole}), ts_epoch) AS latest"), F.expr("bool_or(wanted) AS asked")
    )
    before = f"lag(latest) OVER (PARTITION BY {key} ORDER BY slot) AS latest"
    return (
        used.selectExpr(key, "slot", "asked", before)
        .filter("asked AND latest IS NOT NULL")
        .selectExpr(key, "slot", "latest.ts_epoch", "latest.last_row", f"'{CARRIED}' AS role")
    )


def _frame(key: str, seconds_back: int) -> str:
    return f"(PARTITION BY {key}, slot ORDER BY ts_epoch RANGE BETWEEN {seconds_back} PRECEDING AND 1 PRECEDING)"


def _count_over(key: str, column: str, seconds_back: int) -> str:
    """Sum of whole numbers over a frame: two running totals, one up to before the frame.

    Unlike a sliding frame, which adds up all its rows again for every row, this costs linear time
    however many seconds a frame holds; differences of whole numbers are exact.
    """
    totals = [
        f"coalesce(sum({column}) OVER (PARTITION BY {key}, slot ORDER BY ts_epoch "
        f"RANGE BETWEEN UNBOUNDED PRECEDING AND {end} PRECEDING), 0)"
        for end in (1, seconds_back + 1)
    ]
    return " - ".join(totals)


def _over_one_slot(key: str, function: str, column: str) -> tuple[str, str]:
    """The two halves of a frame as long as a slot: its own slot so far, the last one's rest."""
    running = f"(PARTITION BY {key}, slot ORDER BY ts_epoch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    backwards = f"(PARTITION BY {key}, slot ORDER BY countdown RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (
        f"{function}(CASE WHEN role = '{OWN}' THEN {column} END) OVER {running}",
        f"{function}(CASE WHEN role = '{REACHED}' THEN {column} END) OVER {backwards}",
    )


def _row_before(key: str) -> str:
    """Last row of the key's previous used second, from the slot itself or the carried row."""
    running = f"(PARTITION BY {key}, slot ORDER BY ts_epoch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"last(CASE WHEN role <> '{REACHED}' THEN last_row END, true) OVER {running} AS row_before"


KEPT = f"role = '{OWN}' AND wanted AS kept"


def _last_row(payload: tuple[str, ...]) -> str:
    """Latest row of a second or, with its time in front, of collapsed older seconds."""
    return f"max(struct(ts_epoch, {', '.join(payload)}))"


def card_seconds(
    batch: DataFrame, history: DataFrame | None, since: int | None = None, snapshot=None, few_keys: bool = False
) -> DataFrame:
    """Card windows and the row before for each (card_key, ts_epoch) with batch rows."""
    key = "card_key"
    measures = {"n": "count(1)", "total": "sum(amount)", "low": "min(amount)", "last_row": _last_row(CARD_PAYLOAD)}
    older = (None, None) if snapshot is None else (snapshot.last_card, snapshot.as_of)
    seconds = _second_rows(batch, history, key, CARD_PAYLOAD, measures, since, ONE_DAY, True, *older, few_keys)
    counts = {
        "velocity_1min": ONE_MINUTE,
        "velocity_5min": FIVE_MINUTES,
        "velocity_1h": ONE_HOUR,
        "velocity_24h": ONE_DAY,
        "count_10min": TEN_MINUTES,
    }
    ten = _frame(key, TEN_MINUTES)
    return (
        _in_slots(seconds, key, CARD_SLOT, ONE_DAY, since, carry=True)
        .selectExpr(
            key,
            "ts_epoch",
            KEPT,
            _row_before(key),
            *[f"{_count_over(key, 'n', length)} AS {name}" for name, length in counts.items()],
            f"sum(total) OVER {ten} AS sum_10min",
            f"min(low) OVER {ten} AS min_10min",
        )
        .filter("kept")
        .drop("kept")
    )


# Count, mean and centred squares of amounts; equal amounts have exactly their own mean.
_MOMENTS = {
    "n": "count(amount)",
    "mean": "CASE WHEN min(amount) = max(amount) THEN min(amount) ELSE avg(amount) END",
    "squares": "CASE WHEN min(amount) = max(amount) THEN 0D ELSE var_pop(amount) * count(amount) END",
}


def day_moments(rows: DataFrame) -> DataFrame:
    """Count, mean and centred squares of the amounts of each (customer_key, day) of aligned rows.

    Such rows of several batches may stand side by side; readers merge them.
    """
    known = rows.filter("ts_epoch IS NOT NULL AND amount IS NOT NULL")
    day = F.expr(f"{_slot(ONE_DAY)} AS day")
    return known.groupBy("customer_key", day).agg(*[F.expr(f"{text} AS {name}") for name, text in _MOMENTS.items()])


def _whole_days(moments: DataFrame, asked: DataFrame) -> DataFrame:
    """Moments of the 89 days before each asked (customer_key, day), as n_whole, mean_whole, rest_whole.

    A customer has one row per day and batch here, however many transactions there were.
    """
    key = "customer_key"
    marked = moments.select(key, "day", "n", "mean", "squares", F.lit(False).alias("asked")).unionByName(
        asked.selectExpr(key, "day", "0L AS n", "CAST(NULL AS DOUBLE) AS mean", "0D AS squares", "true AS asked"))
    near = "first(mean, true) OVER (PARTITION BY customer_key ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    shifted = marked.selectExpr("*", f"{near} AS shift")
    frame = "OVER (PARTITION BY customer_key ORDER BY day RANGE BETWEEN 89 PRECEDING AND 1 PRECEDING)"
    summed = shifted.selectExpr(
        key, "day", "asked", "shift",
        f"coalesce(sum(n) {frame}, 0) AS n_whole",
        f"coalesce(sum(n * (mean - shift)) {frame}, 0D) AS moved",
        f"coalesce(sum(squares + n * (mean - shift) * (mean - shift)) {frame}, 0D) AS moved_squares",
    ).filter("asked")
    return summed.selectExpr(
        key, "day AS slot", "n_whole",
        "CASE WHEN n_whole > 0 THEN shift + moved / n_whole END AS mean_whole",
        "CASE WHEN n_whole > 0 THEN greatest(moved_squares - moved * moved / n_whole, 0D) ELSE 0D END AS rest_whole")


def _merged(df: DataFrame, first: str, second: str, into: str) -> DataFrame:
    """Adds the moments of two parts as one; nothing of the size of a squared amount is subtracted."""
    n, apart = f"(n_{first} + n_{second})", f"coalesce(mean_{first} - mean_{second}, 0D)"
    share = [f"coalesce(mean_{part} * (n_{part} / {n}), 0D)" for part in (first, second)]
    return df.selectExpr(
        "*",
        f"{n} AS n_{into}",
        f"CASE WHEN {n} > 0 THEN {' + '.join(share)} END AS mean_{into}",
        f"rest_{first} + rest_{second} + CASE WHEN {n} > 0 THEN {apart} * {apart} * n_{first} * (n_{second} / {n}) ELSE 0D END"
        f" AS rest_{into}")


def customer_seconds(
    batch: DataFrame,
    history: DataFrame | None,
    since: int | None = None,
    few_keys: bool = False,
    moments: DataFrame | None = None,
    days: list[int] | None = None,
) -> DataFrame:
    """90-day spending profile for each (customer_key, ts_epoch) with batch rows.

    A second keeps the number of its amounts, their mean and their centred squares. The parts of
    a frame are summed as distances from a shift near the part's own amounts, which stay small
    where amounts are large, and are then combined by the rule for merging moments.

    ``moments`` are the day moments of all history. With them, and with ``days``, the days since
    1970 on which the batch has rows, history is read for the two days only where a frame
    begins or ends inside; the 89 whole days between them come from the moments.
    """
    key = "customer_key"
    slot, ahead = (NINETY_DAYS, 1) if moments is None else (ONE_DAY, NINETY_DAYS // ONE_DAY)
    if moments is not None:
        if since is None or days is None:
            raise ValueError("day moments need the first second and the days of the batch")
        edges = sorted({*days, *(day - ahead for day in days)})
        if history is not None:
            if "dt" in history.columns:
                history = history.filter(F.col("dt").isin([date.fromordinal(_EPOCH + day) for day in edges]))
            history = history.filter(F.expr(_slot(ONE_DAY)).isin(edges))
    seconds = _second_rows(
        batch, history, key, ("amount",), _MOMENTS, since, NINETY_DAYS, keep_older=False, few_keys=few_keys
    )
    shift = f"percentile_approx(CASE WHEN role = '{{}}' THEN mean END, 0.5) OVER (PARTITION BY {key}, slot)"
    # A slot without a row of the batch is left before anything is computed for it.
    asked = f"bool_or(wanted AND role = '{OWN}') OVER (PARTITION BY {key}, slot) AS asked"
    placed = _in_slots(seconds, key, slot, slot, since, ahead=ahead).selectExpr("*", asked).filter("asked")
    placed = placed.drop("asked").selectExpr(
        "*", f"{shift.format(OWN)} AS shift_own", f"{shift.format(REACHED)} AS shift_old"
    ).selectExpr("*", f"CASE WHEN role = '{OWN}' THEN shift_own ELSE shift_old END AS shift")
    moved = placed.selectExpr(
        "*", "n * (mean - shift) AS moved", "squares + n * (mean - shift) * (mean - shift) AS moved_squares"
    )
    halves = {}
    for column in ("n", "moved", "moved_squares"):
        for name, half in zip(("own", "old"), _over_one_slot(key, "sum", column), strict=True):
            halves[f"{column}_{name}"] = f"coalesce({half}, 0)"
    summed = moved.selectExpr(
        key,
        "ts_epoch",
        "slot",
        KEPT,
        "shift_own",
        "shift_old",
        *[f"{text} AS {name}" for name, text in halves.items()],
    ).filter("kept")
    found = summed.selectExpr(
        key, "ts_epoch", "slot", "n_own", "n_old",
        *[f"CASE WHEN n_{h} > 0 THEN shift_{h} + moved_{h} / n_{h} END AS mean_{h}" for h in ("own", "old")],
        *[f"CASE WHEN n_{h} > 0 THEN greatest(moved_squares_{h} - moved_{h} * moved_{h} / n_{h}, 0D) ELSE 0D END AS rest_{h}"
          for h in ("own", "old")],
    )
    found = _merged(found, "own", "old", "both")
    part = "both"
    if moments is not None:
        asked = batch.filter("ts_epoch IS NOT NULL").select(key, F.expr(f"{_slot(ONE_DAY)} AS day")).distinct()
        kept = moments.filter(F.col("day") >= since // ONE_DAY - ahead)
        if "dt" in moments.columns:
            kept = kept.filter(F.col("dt") >= day_literal(since - NINETY_DAYS)).drop("dt")
        if few_keys:
            kept = kept.join(F.broadcast(asked.select(key).distinct()), key, "left_semi")
        whole = _whole_days(kept.unionByName(day_moments(batch)), asked)
        found = _merged(found.join(whole, [key, "slot"]), "both", "whole", "all")
        part = "all"
    return found.selectExpr(
        key,
        "ts_epoch",
        f"coalesce(mean_{part}, 0D) AS amount_mean_90d",
        f"CASE WHEN n_{part} > 1 THEN sqrt(rest_{part} / (n_{part} - 1)) ELSE 0D END AS amount_std_90d",
        f"n_{part} AS amount_count_90d",
    )


def bin_seconds(
    batch: DataFrame,
    history: DataFrame | None,
    since: int | None = None,
    window_seconds: int = 900,
    snapshot=None,
    few_keys: bool = False,
) -> DataFrame:
    """Recent denials and the row before for each (bin, ts_epoch) with batch rows."""
    if not 0 < window_seconds <= ONE_DAY:
        raise ValueError("the BIN window must be between one second and one day")
    key = "bin"
    measures = {"denials": "count_if(auth_result = 'declined')", "last_row": _last_row(BIN_PAYLOAD)}
    older = (None, None) if snapshot is None else (snapshot.last_bin, snapshot.as_of)
    seconds = _second_rows(batch, history, key, BIN_PAYLOAD, measures, since, window_seconds, True, *older, few_keys)
    return (
        _in_slots(seconds, key, ONE_DAY, window_seconds, since, carry=True)
        .selectExpr(
            key,
            "ts_epoch",
            KEPT,
            _row_before(key),
            f"{_count_over(key, 'denials', window_seconds)} AS bin_denials_15min",
        )
        .filter("kept")
        .drop("kept")
    )


def _borders(rows: DataFrame, key: str) -> DataFrame:
    """For each crowded (key, second), ids that cut it into ranges of about equal size.

    Only sampled ids are shuffled, so a second with two or more of them holds thousands of rows. The
    borders decide where rows are ordered, never in which order.
    """
    sampled = rows.filter(f"ts_epoch IS NOT NULL AND pmod(xxhash64(transaction_id), {BORDER_RATE}) = 0")
    marks = sampled.groupBy(key, "ts_epoch").agg(F.expr("sort_array(collect_list(transaction_id)) AS marks"))
    step = f"ceil(size(marks) / {MOST_BORDERS})"
    return marks.filter("size(marks) > 1").selectExpr(
        key, "ts_epoch", f"filter(marks, (mark, k) -> k % {step} = 0) AS borders")


def _in_ranges(rows: DataFrame, borders: DataFrame, key: str, how: str) -> DataFrame:
    """Adds ``id_range``, the number of borders up to the row's id; 0 in seconds without borders."""
    placed = rows.join(borders, [key, "ts_epoch"], how)
    at = "coalesce(size(filter(borders, border -> border <= transaction_id)), 0)"
    return placed.withColumn("id_range", F.expr(f"CASE WHEN borders IS NULL THEN 0 ELSE {at} END")).drop("borders")


def _with_row_before(
    batch: DataFrame,
    beside: DataFrame | None,
    seconds: DataFrame,
    key: str,
    payload: tuple[str, ...],
    as_of: DataFrame | None,
) -> DataFrame:
    """Joins the window values and completes ``row_before`` inside the second.

    The row before is the one with the next smaller id in the same second, else the last
    row of the previous used second. ``beside`` is history that may share seconds with the
    batch. With ``as_of``, all rows there are, a row of the same second that happened later
    is not a predecessor. The rows of a crowded second are ordered in ranges of ids, each in a
    group of its own; the first row of a range gets the last one of the range before.
    """
    rows = batch
    if beside is not None:
        rows = batch.unionByName(beside.select(key, "ts_epoch", "is_batch", *payload), allowMissingColumns=True)
        seconds = seconds.withColumn("matched", F.lit(True))
    joined = rows.join(seconds, [key, "ts_epoch"], "left")
    if beside is not None:
        joined = joined.filter("is_batch OR matched").drop("matched")
    columns = [f"`{c}`" for c in joined.columns if c != "row_before"]
    row, ranges, borders = f"struct(ts_epoch, {', '.join(payload)})", [key, "ts_epoch", "id_range"], _borders(rows, key)
    ends = _in_ranges(rows, borders, key, "inner").groupBy(*ranges).agg(F.expr(f"max_by({row}, transaction_id) AS end"))
    carried = ends.selectExpr(*ranges, f"lag(end) OVER (PARTITION BY {key}, ts_epoch ORDER BY id_range) AS carried")
    # The shuffle is asked for: one on (key, second) would satisfy the window as well.
    placed = _in_ranges(joined, borders, key, "left").repartition(*ranges).join(carried, ranges, "left")
    in_range = f"lag({row}) OVER (PARTITION BY {', '.join(ranges)} ORDER BY transaction_id)"
    chained = placed.selectExpr(*columns, f"coalesce({in_range}, carried) AS beside", "row_before AS earlier")
    if beside is not None:
        chained = chained.filter("is_batch")
    neighbour = "beside"
    if as_of is not None:
        chained = chained.join(in_second_predecessors(as_of, key, payload), "transaction_id", "left")
        neighbour = "CASE WHEN beside.timestamp > timestamp THEN repaired ELSE beside END"
    return chained.selectExpr(*columns, f"coalesce({neighbour}, earlier) AS row_before")


def with_windows(
    batch: DataFrame,
    history: DataFrame | None,
    since: int | None = None,
    bin_window_seconds: int = 900,
    history_ended: bool = False,
    families: tuple[str, ...] = ("card", "customer", "bin"),
    as_of: DataFrame | None = None,
    snapshot=None,
    few_keys: bool = False,
    moments: DataFrame | None = None,
    days: list[int] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Adds the window features and predecessors of aligned batch rows, whose ids are unique.

    ``since`` is a lower bound, in epoch seconds, of the batch time and limits how much
    history is read. ``history_ended`` promises that history ends before the first second
    of the batch. ``as_of`` asks for the predecessors of a replay, see ``_with_row_before``.
    ``snapshot`` stands for history before its day, which must end a day or more before
    ``since``; ``few_keys`` says that the keys of the batch are few enough to broadcast.
    ``moments`` and ``days`` shorten what the spending profile reads, see ``customer_seconds``.
    ``keep`` stores the features of a family under its name and reads them back, so that the
    shuffles of one family at a time are on disk.
    """
    if snapshot is not None and (since is None or snapshot.as_of > since - ONE_DAY):
        raise ValueError("a snapshot must end at least a day before the batch begins")
    beside = None if history is None or history_ended else since_seconds(history, since)
    # Each family works on a few columns and returns (transaction_id, features), so the wide
    # rows are shuffled once, on the id, where all families meet.
    found = []
    if "card" in families:
        narrow = batch.select("card_key", "ts_epoch", "is_batch", *CARD_PAYLOAD)
        seconds = card_seconds(batch, history, since, snapshot, few_keys)
        found.append(
            _with_row_before(narrow, beside, seconds, "card_key", CARD_PAYLOAD, as_of).selectExpr(
                "transaction_id",
                *[f"coalesce({c}, 0L) AS {c}" for c in ("velocity_1min", "velocity_5min", "velocity_1h")],
                *[f"coalesce({c}, 0L) AS {c}" for c in ("velocity_24h", "count_10min")],
                *[f"coalesce({c}, 0D) AS {c}" for c in ("sum_10min", "min_10min")],
                "row_before.timestamp AS prev_ts",
                *[f"row_before.{c} AS prev_{c}" for c in CARD_PAYLOAD[2:]],
                "row_before.transaction_id AS previous_transaction_id",
            )
        )
    if "customer" in families:
        narrow = batch.select("transaction_id", "customer_key", "ts_epoch")
        seconds = customer_seconds(batch, history, since, few_keys, moments, days)
        found.append(
            narrow.join(seconds, ["customer_key", "ts_epoch"], "left").selectExpr(
                "transaction_id",
                "coalesce(amount_mean_90d, 0D) AS amount_mean_90d",
                "coalesce(amount_std_90d, 0D) AS amount_std_90d",
                "coalesce(amount_count_90d, 0L) AS amount_count_90d",
            )
        )
    if "bin" in families:
        narrow = batch.select("bin", "ts_epoch", "is_batch", *BIN_PAYLOAD)
        seconds = bin_seconds(batch, history, since, bin_window_seconds, snapshot, few_keys)
        found.append(
            _with_row_before(narrow, beside, seconds, "bin", BIN_PAYLOAD, as_of).selectExpr(
                "transaction_id",
                "coalesce(bin_denials_15min, 0L) AS bin_denials_15min",
                "coalesce(row_before.auth_result = 'approved', false) AS prev_bin_approved",
            )
        )
    if keep is not None:
        names = [f for f in ("card", "customer", "bin") if f in families]
        found = [keep(features, f"{name}-features") for features, name in zip(found, names, strict=True)]
    out = batch
    for features in found:
        out = out.join(features, "transaction_id", "left")
    return out.select(*[F.col(f"`{c}`") for c in batch.columns], *[c for f in found for c in f.columns[1:]])
