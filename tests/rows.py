"""Small transaction tables for tests, and a row-by-row model of the features."""

import math
import random
import statistics
from datetime import datetime, timedelta, timezone

from vigilcard.schemas import RAW

START = datetime(2026, 3, 10, 14, 0, 0)
CITIES = ("São Paulo", "Manaus", "Recife", "Nowhere", None)


def tx(**changes):
    """One raw row with the given changes."""
    row = {
        "transaction_id": "t1",
        "customer_id": "C1",
        "card_id": "4532010000000001",
        "timestamp": START,
        "amount": 50.0,
        "currency": "BRL",
        "merchant_id": "M1",
        "merchant_category": "5411",
        "merchant_city": "São Paulo",
        "merchant_country": "BR",
        "terminal_id": "T1",
        "entry_mode": "chip",
        "device_id": "D1",
        "channel": "pos",
        "auth_result": "approved",
    }
    return {**row, **changes}


def frame(spark, rows):
    """Rows as a DataFrame in the raw layout."""
    data = [
        tuple(r[c].replace(tzinfo=timezone.utc) if isinstance(r[c], datetime) else r[c] for c in RAW.names)
        for r in rows
    ]
    return spark.createDataFrame(data, RAW)


def collect(df, *columns):
    """Chosen columns by transaction id, times as zone-free UTC."""
    out = {}
    for row in df.select("transaction_id", *columns).collect():
        out[row["transaction_id"]] = row.asDict()
    return out


def random_rows(seed, count, days=120):
    """Bursts on few cards: shared seconds, ids out of time order, missing values, idle gaps."""
    rng = random.Random(seed)
    ids = [f"t{n:05d}" for n in range(count)]
    rng.shuffle(ids)
    bursts = [START + timedelta(seconds=rng.randrange(days * 86400)) for _ in range(max(2, count // 25))]
    rows = []
    for id_ in ids:
        burst = rng.choice(bursts)
        when = burst + timedelta(
            seconds=rng.choice((0, 0, 1, rng.randrange(120), rng.randrange(4000), rng.randrange(2 * 86400))),
            microseconds=rng.choice((0, 0, 250_000, rng.randrange(1_000_000))),
        )
        card = rng.choice(("4532010000000001",) * 4 + ("4532010000000002", "4024000000000003", None))
        rows.append(
            tx(
                transaction_id=id_,
                customer_id=rng.choice(("C1", "C1", "C2", None)),
                card_id=card,
                timestamp=when,
                amount=rng.choice((None, 4.35, 4.35, round(rng.uniform(1, 900), 2))),
                merchant_city=rng.choice(CITIES),
                terminal_id=f"T{rng.randrange(4)}",
                device_id=rng.choice((None, "D1", "D2", f"N{rng.randrange(50)}")),
                entry_mode=rng.choice(("chip", "chip", "contactless", "magnetic", None)),
                auth_result=rng.choice(("approved", "declined")),
            )
        )
    return rows


def _epoch(row):
    return math.floor((row["timestamp"] - datetime(1970, 1, 1)).total_seconds())


def model(row, rows, seen):
    """Features of one row given all rows the windows see and the rows novelty looks at."""
    t = _epoch(row)
    key = lambda r: r["card_id"] or ""
    card = [r for r in rows if key(r) == key(row)]
    customer = [r for r in rows if (r["customer_id"] or "") == (row["customer_id"] or "")]
    bins = [r for r in rows if key(r)[:6] == key(row)[:6]]

    def within(group, seconds):
        return [r for r in group if t - seconds <= _epoch(r) <= t - 1]

    def before(group):
        earlier = [r for r in group if (_epoch(r), r["transaction_id"]) < (t, row["transaction_id"])]
        return max(earlier, key=lambda r: (_epoch(r), r["transaction_id"]), default=None)

    ten = [r["amount"] for r in within(card, 600) if r["amount"] is not None]
    profile = [r["amount"] for r in within(customer, 7776000) if r["amount"] is not None]
    previous, previous_bin = before(card), before(bins)
    known = [r for r in seen if r["card_id"] is not None and r["card_id"] == row["card_id"]]

    def new(column):
        return all(r[column] is None or r[column] != row[column] for r in known)

    return {
        "velocity_1min": len(within(card, 60)),
        "velocity_5min": len(within(card, 300)),
        "velocity_1h": len(within(card, 3600)),
        "velocity_24h": len(within(card, 86400)),
        "count_10min": len(within(card, 600)),
        "sum_10min": float(sum(ten)),
        "min_10min": min(ten, default=0.0),
        "amount_mean_90d": sum(profile) / len(profile) if profile else 0.0,
        "amount_std_90d": statistics.stdev(profile) if len(profile) > 1 else 0.0,
        "amount_count_90d": len(profile),
        "bin_denials_15min": sum(r["auth_result"] == "declined" for r in within(bins, 900)),
        "prev_bin_approved": previous_bin is not None and previous_bin["auth_result"] == "approved",
        "previous_transaction_id": previous and previous["transaction_id"],
        "prev_merchant_city": previous and previous["merchant_city"],
        "prev_device_id": previous and previous["device_id"],
        "prev_amount": previous and previous["amount"],
        "new_terminal": new("terminal_id"),
        "new_device": new("device_id"),
        "new_city": new("merchant_city"),
        "entry_mode_chip_only_history": all(r["entry_mode"] in ("chip", "contactless", None) for r in known),
    }

