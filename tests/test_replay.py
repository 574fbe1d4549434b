"""Replay: stored decisions against decisions recomputed from each row's own past."""

from datetime import datetime, timedelta

import pytest
from rows import START, _epoch, collect, frame, model, random_rows, tx

from vigilcard.config import default_config
from vigilcard.operators.align import align
from vigilcard.operators.novelty import with_novelty_as_of
from vigilcard.operators.seconds import with_windows
from vigilcard.plans.batch import process_batch
from vigilcard.plans.replay import recompute_decisions, verify_replay
from vigilcard.sources.layers import LayerStore

CONFIG = default_config()
NOW = datetime(2026, 4, 1)


def past_of(row, rows):
    return [
        r for r in rows
        if r["timestamp"] < row["timestamp"]
        or (r["timestamp"] == row["timestamp"] and r["transaction_id"] != row["transaction_id"])
    ]


@pytest.mark.parametrize("seed, share", [(21, None), (22, 3)])
def test_every_row_sees_only_its_past(spark, seed, share):
    from pyspark.sql import functions as F

    rows = random_rows(seed, 200, days=5)
    wanted = rows if share is None else rows[::share]
    everything = align(frame(spark, rows))
    batch, rest = everything, None
    if share is not None:
        ids = spark.createDataFrame([(r["transaction_id"],) for r in wanted], "transaction_id string")
        batch = everything.join(ids, "transaction_id", "left_semi")
        rest = everything.join(ids, "transaction_id", "left_anti").withColumn("is_batch", F.lit(False))
    batch = batch.withColumn("is_batch", F.lit(True))
    timed = with_windows(batch, rest, None, as_of=everything)
    df = with_novelty_as_of(timed, batch, everything)
    expected = {r["transaction_id"]: model(r, [r, *past_of(r, rows)], past_of(r, rows)) for r in wanted}
    got = collect(df, *next(iter(expected.values())))
    assert len(got) == len(wanted)
    for id_, features in expected.items():
        close = {k: pytest.approx(v, abs=1e-6) if isinstance(v, float) else v for k, v in features.items()}
        assert got[id_] == {"transaction_id": id_, **close}, id_


def test_ids_against_time_inside_one_second(spark):
    """Ids fall while times rise, so the neighbour by id is never the row before."""
    rows = [
        tx(transaction_id=f"t{30 - n:02d}", timestamp=START + timedelta(microseconds=n * n * 1000), amount=float(n + 1))
        for n in range(20)
    ]
    rows.append(tx(transaction_id="t99", timestamp=START + timedelta(microseconds=50_000)))
    got = {r["transaction_id"]: r for r in recompute_decisions(frame(spark, rows), CONFIG, NOW).collect()}
    for r in rows:
        before = [p for p in past_of(r, rows) if (_epoch(p), p["transaction_id"]) < (_epoch(r), r["transaction_id"])]
        best = max(before, key=lambda p: p["transaction_id"], default=None)
        assert got[r["transaction_id"]]["previous_transaction_id"] == (best and best["transaction_id"])


def test_verdicts(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "layers"))
    rows = [tx(transaction_id="a"), tx(transaction_id="b", card_id="4024009876543210", customer_id="C2", amount=9500.0)]
    process_batch(frame(spark, rows), store, CONFIG, NOW).release()
    ids = spark.createDataFrame([("a",), ("b",), ("nobody",)], "transaction_id string")
    verdicts = verify_replay(store.read("raw"), store.read("enriched"), CONFIG, NOW, ids)
    got = {r["transaction_id"]: r for r in verdicts.collect()}
    assert got["a"]["idempotent"] and got["b"]["idempotent"]
    assert got["a"]["stored_level"] == got["a"]["recomputed_level"]
    assert got["nobody"]["status"] == "not_in_enriched" and not got["nobody"]["idempotent"]
    everything = verify_replay(store.read("raw"), store.read("enriched"), CONFIG, NOW)
    assert everything.filter("idempotent").count() == 2
    without = verify_replay(store.read("raw").filter("transaction_id = 'a'"), store.read("enriched"), CONFIG, NOW)
    assert {r["transaction_id"]: r["status"] for r in without.collect()} == {"a": "idempotent", "b": "not_in_raw"}
