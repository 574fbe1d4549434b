"""History snapshots change what is read, never what is decided."""

from datetime import date, datetime, timedelta

import pytest
from rows import START, frame, random_rows, tx

from vigilcard.config import default_config
from vigilcard.plans import batch as batches
from vigilcard.plans.batch import process_batch
from vigilcard.plans.scoring import transaction_features
from vigilcard.sources.layers import LayerStore

CONFIG = default_config()
NOW = datetime(2026, 8, 1)


def outcome(store, rows, spark):
    result = process_batch(frame(spark, rows), store, CONFIG, NOW)
    out = sorted(tuple(r) for r in result.enriched.select("*").collect())
    result.release()
    return out


def test_same_decisions_with_and_without(spark, tmp_path, monkeypatch):
    """One store uses snapshots and broadcast keys, the other neither."""
    rows = sorted(random_rows(41, 160, days=60), key=lambda r: r["timestamp"])
    history, late, first, second = rows[:70], rows[70:80], rows[80:120], rows[120:]
    late += [tx(transaction_id="none", card_id="4024000000000003", timestamp=None, device_id="ONLY")]
    second = second + [tx(transaction_id="again", card_id="4024000000000003", device_id="ONLY",
                          timestamp=second[-1]["timestamp"])]
    plain, quick = (LayerStore(spark, str(tmp_path / n)) for n in ("plain", "quick"))
    day = first[0]["timestamp"].date() - timedelta(days=1)
    for store in (plain, quick):
        store.append_new("raw", frame(spark, history))
    quick.write_snapshot(day - timedelta(days=5))
    quick.write_snapshot(day)
    for part in (first, late, second):
        monkeypatch.setattr(batches, "BROADCAST_KEYS", 0)
        expected = outcome(plain, part, spark)
        monkeypatch.setattr(batches, "BROADCAST_KEYS", 200_000)
        assert outcome(quick, part, spark) == expected


def test_late_rows_are_scored_apart(spark, tmp_path):
    """A batch with old rows beside new ones gives the same decisions, and the new ones still
    prune history by day."""
    rows = sorted(random_rows(43, 140, days=40), key=lambda r: r["timestamp"])
    history, batch = rows[:90], rows[90:]
    late = [tx(transaction_id=f"late{k}", card_id=r["card_id"], customer_id=r["customer_id"], amount=7.0 + k,
               device_id="LATE", timestamp=r["timestamp"] - timedelta(days=d))
            for k, (r, d) in enumerate(zip(batch, (0, 5, 25, 33), strict=False))]
    plain, quick = (LayerStore(spark, str(tmp_path / n)) for n in ("plain", "quick"))
    for store in (plain, quick):
        store.append_new("raw", frame(spark, history))
    day = batch[0]["timestamp"].date() - timedelta(days=1)
    quick.write_snapshot(day - timedelta(days=9))
    quick.write_snapshot(day)
    expected = outcome(plain, batch + late, spark)
    assert batches._late_border(quick, 0, 2**40) is not None
    assert outcome(quick, batch + late, spark) == expected


def test_snapshots_are_taken_at_day_borders(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    for k in range(4):
        row = tx(transaction_id=f"t{k}", timestamp=START + timedelta(hours=13 * k))
        process_batch(frame(spark, [row]), store, CONFIG, NOW, keep_snapshots=True).release()
    assert len(store._snapshots()) == 3  # one for each day that began


def test_late_rows_and_fast_clocks_do_not_stop_renewal(spark, tmp_path):
    """Each batch holds a row of a month ago, the last one of next year; four snapshots stay."""
    store, taken = LayerStore(spark, str(tmp_path)), []
    for k in range(7):
        store.append_new("raw", frame(spark, [tx(transaction_id=f"t{k}", timestamp=START + timedelta(days=k))]))
        store.maintain_snapshot(int((START + timedelta(days=k) - datetime(1970, 1, 1)).total_seconds()))
        taken.append(store._snapshots())
    assert [len(t) for t in taken] == [1, 2, 3, 4, 4, 4, 4] and taken[6][0] == taken[3][3]
    store.add_late_rows(frame(spark, [tx(transaction_id="late", card_id="9", timestamp=START - timedelta(days=9))]), None)
    seen = store.snapshot_before(2**40).seen
    assert "9" in {r.card_id for r in seen.collect()} and "batch" not in seen.columns


def test_batches_renew_by_their_latest_row(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    late, ahead = tx(transaction_id="l", timestamp=START - timedelta(days=31)), tx(transaction_id="f", timestamp=datetime(2027, 1, 1))
    process_batch(frame(spark, [tx(), late, ahead]), store, CONFIG, START + timedelta(hours=1), keep_snapshots=True).release()
    day = START.replace(hour=0, minute=0) - timedelta(days=1)
    assert store._snapshots() == [int((day - datetime(1970, 1, 1)).total_seconds())]


def test_snapshot_must_end_before_the_batch(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.write_snapshot(date(2026, 3, 1))
    store.append_new("raw", frame(spark, [tx()]))
    store.write_snapshot(date(2026, 3, 11))
    snapshot = store.snapshot_before(2**40)
    assert store.snapshot_before(snapshot.as_of - 1) is None
    later = frame(spark, [tx(transaction_id="t2", timestamp=START + timedelta(days=1))])
    since = int((START + timedelta(days=1) - datetime(1970, 1, 1)).total_seconds())
    with pytest.raises(ValueError):
        transaction_features(later, store.read("raw"), CONFIG, since, snapshot=snapshot)
