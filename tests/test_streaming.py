"""Streams: parsing, equality with a batch run, statistics and repeated delivery."""

from datetime import datetime, timedelta

import pytest
from rows import START, frame, random_rows, tx

from vigilcard.config import default_config
from vigilcard.plans.batch import process_batch
from vigilcard.schemas import RAW
from vigilcard.sources.layers import DATED, LayerStore
from vigilcard.streaming import jobs, sources

CONFIG = default_config()
NOW = datetime(2026, 4, 1)


def write_lines(df, path):
    df.select(sources.transaction_json().alias("value")).coalesce(1).write.mode("append").text(path)


def run(spark, lines, store, checkpoint, per_batch=1000):
    stream = sources.read_json_lines(spark, CONFIG, lines, per_batch)
    jobs.start_scoring(stream, store, CONFIG, checkpoint, available_now=True, decision_ts=NOW).awaitTermination()


def test_json_round_trip_and_bad_lines(spark):
    rows = [tx(device_id=None), tx(transaction_id="t2", timestamp=START + timedelta(microseconds=123456))]
    df = frame(spark, rows)
    lines = df.select(sources.transaction_json().alias("value"))
    text = {r["value"] for r in lines.collect()}
    assert any('"timestamp":"2026-03-10T14:00:00"' in t and '"device_id":null' in t and "São" in t for t in text)
    bad = spark.createDataFrame([("{broken",), ('{"amount": 1}',)], "value string")
    good, rejected = sources.split_bad_records(lines.union(bad))
    assert sorted(good.collect()) == sorted(df.collect())
    assert {r["line"] for r in rejected.collect()} == {"{broken", '{"amount": 1}'}
    assert sources.parse_transactions(bad).filter("transaction_id IS NULL").count() == 2
    assert good.schema.names == RAW.names


def test_stream_equals_batch(spark, tmp_path):
    rows = sorted(random_rows(31, 120, days=10), key=lambda r: r["timestamp"])
    history, batch = rows[:60], rows[60:]
    by_batch, by_stream = (LayerStore(spark, str(tmp_path / name)) for name in ("batch", "stream"))
    for store in (by_batch, by_stream):
        store.append_new("raw", frame(spark, history))
    process_batch(frame(spark, batch), by_batch, CONFIG, NOW).release()
    lines = str(tmp_path / "lines")
    write_lines(frame(spark, batch), lines)
    run(spark, lines, by_stream, str(tmp_path / "checkpoint"))
    for layer in ("raw", "enriched", "alerts"):
        expected = by_batch.read(layer).drop("feature_snapshot").orderBy("transaction_id").collect()
        assert by_stream.read(layer).drop("feature_snapshot").orderBy("transaction_id").collect() == expected
    stats = jobs.session_stats(spark, by_stream).first()
    assert stats["processed"] == 60
    assert stats["approve"] + stats["review"] + stats["block"] == 60


def test_two_micro_batches_and_second_delivery(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "layers"))
    assert jobs.session_stats(spark, store) is None and jobs.session_rule_counts(spark, store) is None
    lines = str(tmp_path / "lines")
    probe = tx(amount=4.5, entry_mode="magnetic")
    clone = tx(transaction_id="t2", amount=2800.0, entry_mode="magnetic", timestamp=START + timedelta(minutes=4))
    for n, row in enumerate((probe, clone)):
        write_lines(frame(spark, [row]), lines)
        run(spark, lines, store, str(tmp_path / "checkpoint"))
    assert jobs.session_stats(spark, store).first().asDict() == {
        "processed": 2, "alerts": 1, "approve": 1, "review": 0, "block": 1, "avg_score": 37.5,
    }
    assert [tuple(r) for r in jobs.session_rule_counts(spark, store).collect()] == [("card_cloning", 1)]
    run(spark, lines, store, str(tmp_path / "other-checkpoint"))
    assert store.read("raw").count() == store.read("enriched").count() == 2
    assert store.read_audit().count() == 4


def test_stream_needs_a_checkpoint(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.start_scoring(frame(spark, [tx()]), LayerStore(spark, str(tmp_path)), CONFIG)


def test_a_stream_compacts_its_dates(spark, tmp_path):
    store, lines = LayerStore(spark, str(tmp_path / "layers")), str(tmp_path / "lines")
    rows = [tx(transaction_id=f"t{k}", timestamp=START + timedelta(minutes=k)) for k in range(2)]
    for k in range(2):
        write_lines(frame(spark, [rows[k]]), lines)
    stream = sources.read_json_lines(spark, CONFIG, lines, 1)
    monkey = pytest.MonkeyPatch()
    compacted = []
    monkey.setattr(jobs.LayerStore, "compact", lambda self, layer: compacted.append(layer))
    try:
        jobs.start_scoring(
            stream, store, CONFIG, str(tmp_path / "checkpoint"), available_now=True, decision_ts=NOW, compact_every=2
        ).awaitTermination()
    finally:
        monkey.undo()
    assert compacted == list(DATED)  # once, after the second of two epochs
    assert store.read("raw").count() == 2
