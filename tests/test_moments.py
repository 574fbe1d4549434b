"""The spending profile from stored moments of days."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import START, frame, random_rows, tx

from vigilcard.config import default_config
from vigilcard.operators.align import align
from vigilcard.operators.seconds import day_moments, with_windows
from vigilcard.plans.batch import process_batch
from vigilcard.sources.layers import LayerStore

CONFIG = default_config()
PROFILE = ("amount_mean_90d", "amount_std_90d", "amount_count_90d")


def epoch(moment):
    return int((moment - datetime(1970, 1, 1)).total_seconds())


def profile(rows):
    return {r.transaction_id: tuple(r[c] for c in PROFILE) for r in rows.collect()}


def test_equals_the_profile_from_all_rows(spark):
    rows = sorted(random_rows(17, 260, days=200), key=lambda r: r["timestamp"])
    border = rows[-1]["timestamp"].replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=20)
    edge = border + timedelta(hours=5)
    rows += [tx(transaction_id=f"e{k}", customer_id="edge", amount=1e7 + k, timestamp=edge - timedelta(days=90, seconds=s))
             for k, s in enumerate((-1, 0, 1, -3600, 86400))]
    rows += [tx(transaction_id="now", customer_id="edge", amount=None, timestamp=edge)]
    past = align(frame(spark, [r for r in rows if r["timestamp"] < border])).withColumn("is_batch", F.lit(False))
    batch = align(frame(spark, [r for r in rows if r["timestamp"] >= border])).withColumn("is_batch", F.lit(True))
    days = [r[0] for r in batch.select(F.expr("ts_epoch div 86400")).distinct().collect()]
    direct = profile(with_windows(batch, past, epoch(border), families=("customer",)))
    # Moments of two batches, so one day may come twice.
    parts = [past.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == k) for k in (0, 1)]
    moments = day_moments(parts[0]).unionByName(day_moments(parts[1]))
    found = profile(with_windows(batch, past, epoch(border), families=("customer",), moments=moments, days=days))
    assert set(found) == set(direct) and found["now"][2] == 3
    for name, wanted in direct.items():
        assert found[name][2] == wanted[2] and found[name][:2] == pytest.approx(wanted[:2], rel=1e-9, abs=1e-6)


def test_moments_need_the_days_of_the_batch(spark):
    rows = align(frame(spark, [tx()])).withColumn("is_batch", F.lit(True))
    with pytest.raises(ValueError):
        with_windows(rows, None, None, families=("customer",), moments=day_moments(rows))


def test_raw_is_read_for_the_edge_days_only(spark, tmp_path):
    """A batch of one day: the profile's scan of raw names that day and the one 90 days before."""
    store = LayerStore(spark, str(tmp_path))
    old = frame(spark, [tx(transaction_id=f"o{k}", amount=float(k), timestamp=START - timedelta(days=k)) for k in range(1, 100)])
    store.append_new("raw", old)
    store.write_day_moments(old)
    rows = align(frame(spark, [tx()])).withColumn("is_batch", F.lit(True))
    past = align(store.read("raw")).withColumn("is_batch", F.lit(False))
    found = with_windows(rows, past, epoch(START), history_ended=True, families=("customer",),
                         moments=store.read_day_moments(), days=[epoch(START) // 86400])
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(p for p in plan.split("PartitionFilters")[1:] if "transaction" in p or "/raw" in p)
    assert str(START.date()) in scan or "dt" in scan.split("]")[0]
    assert profile(found)["t1" if "t1" in profile(found) else tx()["transaction_id"]][2] == 90


def test_batches_that_keep_moments_decide_alike(spark, tmp_path):
    rows = sorted(random_rows(23, 90, days=120), key=lambda r: r["timestamp"])
    stores = [LayerStore(spark, str(tmp_path / name)) for name in ("plain", "kept")]
    for k in range(0, 90, 30):
        for store, keep in zip(stores, (False, True), strict=True):
            process_batch(frame(spark, rows[k : k + 30]), store, CONFIG, START, keep_moments=keep).release()
    assert stores[1].read_day_moments().agg(F.sum("n")).first()[0] == sum(r["amount"] is not None and r["timestamp"] is not None for r in rows)
    plain, kept = ({r.transaction_id: r for r in s.read("enriched").collect()} for s in stores)
    assert {i: (r.risk_level, tuple(r.triggered_rules)) for i, r in plain.items()} == {
        i: (r.risk_level, tuple(r.triggered_rules)) for i, r in kept.items()}
