"""Card, merchant, device and time expressions."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilcard.config import DEFAULT_HIGH_RISK_CATEGORIES

BIN_LENGTH = 6


def bin_prefix(card: Column) -> Column:
    """First six characters of the card number, as used by the BIN windows."""
    return F.substring(card, 1, BIN_LENGTH)


def bin_from_card(card: Column) -> Column:
    """First six digits of the card number, or its first six characters when it has no digit."""
    digits = F.substring(F.regexp_replace(card, "[^0-9]", ""), 1, BIN_LENGTH)
    return F.coalesce(F.nullif(digits, F.lit("")), bin_prefix(card))


def is_blank(value: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(value, F.lit("")) == ""


def high_risk_merchant(category: Column, codes: Iterable[str] = ()) -> Column:
    """Whether the trimmed category code is one of ``codes`` (the stock list when empty)."""
    wanted = list(codes) or list(DEFAULT_HIGH_RISK_CATEGORIES)
    return F.coalesce(F.trim(category).isin(wanted), F.lit(False))


def utc_hour(ts: Column) -> Column:
    """Hour of the day in UTC, whatever the session's zone; null without a time."""
    return F.floor(F.pmod(F.unix_seconds(ts), F.lit(86400)) / 3600).cast("long")


def utc_date(ts: Column) -> Column:
    """Date in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def hour_of_day(ts: Column) -> Column:
    """Hour in UTC, 0 without a time."""
    return F.coalesce(utc_hour(ts), F.lit(0))


def untrusted_hour(hour: Column, start: int = 2, end: int = 5) -> Column:
    """Whether the hour lies in the closed interval [start, end]."""
    return hour.between(start, end)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microsecond resolution; null when either time is."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def minutes_since(ts: Column, previous: Column) -> Column:
    """Minutes since the previous row, never negative; null without one."""
    elapsed = seconds_between(ts, previous) / F.lit(60.0)
    return F.when(elapsed.isNotNull(), F.greatest(elapsed, F.lit(0.0)))


def days_since(ts: Column, previous: Column) -> Column:
    """Days since the previous row, 0 without one; negative inside one second is possible."""
    return F.coalesce(seconds_between(ts, previous) / F.lit(86400.0), F.lit(0.0))


def dormant(days: Column, limit: float = 180.0) -> Column:
    """Whether a card was idle for more than ``limit`` days."""
    return F.coalesce(days > F.lit(float(limit)), F.lit(False))


def two_devices(device: Column, previous: Column) -> Column:
    """Whether both devices are present and differ."""
    return ~is_blank(device) & ~is_blank(previous) & F.coalesce(device != previous, F.lit(False))


def high_velocity(count: Column, window_seconds: int, limit: int | None = None) -> Column:
    """Whether a window count reaches ``limit`` (by default 5, or one per second if that is more)."""
    bound = max(5, 60 // max(1, window_seconds)) if limit is None else limit
    return F.coalesce(count, F.lit(0)) >= F.lit(bound)


def monotonic_counts(*counts: Column) -> Column:
    """Whether counts of ever longer windows never fall."""
    ordered = F.lit(True)
    for shorter, longer in zip(counts, counts[1:]):
        ordered = ordered & (shorter <= longer)
    return ordered


def time_text(ts: Column, separator: str) -> Column:
    """Date and time in UTC as text; the fraction, six digits, only where there is one."""
    second, micro = F.pmod(F.unix_seconds(ts), F.lit(86400)), F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    clock = [F.lpad(F.floor(part).cast("string"), 2, "0") for part in (second / 3600, second % 3600 / 60, second % 60)]
    whole = F.concat_ws(separator, utc_date(ts).cast("string"), F.concat_ws(":", *clock))
    fraction = F.when(micro == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micro.cast("string"), 6, "0")))
    return F.when(ts.isNotNull(), F.concat(whole, fraction))
