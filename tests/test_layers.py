"""Layers: lost rows, killed writes, other session zones, and deltas of profiles."""

import json

import pytest
from rows import START, frame, tx

from vigilcard.config import config_from_dict, default_config
from vigilcard.operators.decisions import timestamp_literal
from vigilcard.operators.profiles import card_profiles
from vigilcard.plans import batch
from vigilcard.plans.batch import process_batch
from vigilcard.plans.replay import recompute_decisions
from vigilcard.plans.scoring import score_transactions
from vigilcard.sources import layers
from vigilcard.sources.layers import LayerStore
from vigilcard.streaming import jobs, sources

CONFIG = default_config()


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "layers"))


def test_rows_without_id_are_rejected_and_repeats_follow_an_order(spark, store):
    rows = [tx(transaction_id=None, amount=float(k)) for k in range(5)]
    rows += [tx(transaction_id="r", amount=a) for a in (1.0, 3.0, 2.0)]
    for part in (rows, rows[::-1]):
        process_batch(frame(spark, part), store, CONFIG, START).release()
        assert [(r.transaction_id, r.amount) for r in store.read("raw").collect()] == [("r", 3.0)]
    rejected = store.read_rejected().collect()
    assert sorted(json.loads(r.line)["amount"] for r in rejected) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_every_line_of_a_stream_is_kept(spark, store, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    good = json.dumps({"transaction_id": "a", "amount": 5.0, "timestamp": "2026-03-10T14:00:00"})
    (folder / "x.json").write_text("\n".join([good, "{broken", "", json.dumps({"amount": 1.0})]) + "\n")
    stream = sources.read_json_lines(spark, CONFIG, str(folder))
    jobs.start_scoring(stream, store, CONFIG, str(tmp_path / "cp"), True, START).awaitTermination()
    assert store.read("raw").count() == 1
    assert sorted(r.line for r in store.read_rejected().collect()) == ["", '{"amount": 1.0}', "{broken"]


def test_profile_writes_survive_empty_batches_and_killed_writes(spark, store, monkeypatch, tmp_path):
    monkeypatch.setattr(layers, "PROFILE_DELTAS", 3)
    now = timestamp_literal(START)

    def write(rows):
        store.write_profiles(card_profiles(score_transactions(frame(spark, rows), None, CONFIG, START), now))

    write([tx(card_id=None)])
    (tmp_path / "layers" / "profiles" / "killed" / "_temporary").mkdir(parents=True)
    for k in range(6):
        write([tx(transaction_id=f"t{k}", amount=float(k), card_id=f"c{k % 2}", timestamp=START.replace(minute=k))])
    assert {r.card_id: r.last_amount for r in store.read_profiles().collect()} == {"c0": 4.0, "c1": 5.0}
    assert len(store._profile_deltas()) <= 4


def test_statistics_of_two_queries_stand_beside_each_other(spark, store):
    enriched = score_transactions(frame(spark, [tx(transaction_id=f"t{k}") for k in range(4)]), None, CONFIG, START)
    jobs.write_epoch_stats(enriched, store, 0, "q1")
    jobs.write_epoch_stats(enriched.limit(1), store, 0, "q2")
    jobs.write_epoch_stats(enriched.limit(1), store, 0, "q2")
    assert jobs.session_stats(spark, store).first()["processed"] == 5


def test_layers_do_not_follow_the_session_zone(spark, store):
    early = START.replace(hour=1)
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        store.append_new("raw", frame(spark, [tx(timestamp=early)]))
        stored = store.read("raw").selectExpr("CAST(dt AS STRING) AS dt").first()["dt"]
        hour = score_transactions(store.read("raw").drop("dt"), None, CONFIG, START).first()["hour_of_day"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (stored, hour) == (early.strftime("%Y-%m-%d"), 1)


def test_window_min_sets_the_bin_window():
    assert CONFIG.bin_window_seconds == 900
    assert config_from_dict({"rules": {"bin_attack": {"params": {"window_min": 30}}}}).bin_window_seconds == 1800
    assert config_from_dict({"bin_window_seconds": 60}).bin_window_seconds == 60


def test_replay_of_few_ids_reads_their_keys_and_days_only(spark, store):
    rows = [tx(transaction_id=f"t{k}", card_id=f"45320{k}0000", customer_id=f"C{k}", timestamp=START.replace(day=1 + k)) for k in range(9)]
    store.append_new("raw", frame(spark, rows))
    ids = spark.createDataFrame([("t3",)], "transaction_id string")
    found = recompute_decisions(store.read("raw"), CONFIG, START, ids)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dt" in plan.split("PartitionFilters")[1].split("]")[0] and "_card_key" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r.transaction_id for r in found.collect()] == ["t3"]


def test_empty_and_missing_card_are_apart(spark):
    rows = [tx(transaction_id="a", card_id=""), tx(transaction_id="b", card_id=None)]
    df = score_transactions(frame(spark, rows), None, CONFIG, START)
    assert {r.previous_transaction_id for r in df.collect()} == {None}


def test_rows_are_grouped_only_if_ids_repeat(spark, store, monkeypatch):
    """Ids that differ cost no grouping of whole rows, in an append and in a batch; repeated ones do."""
    grouped, one_per_id = [], layers.one_per_id
    for module in (layers, batch):
        monkeypatch.setattr(module, "one_per_id", lambda rows: grouped.append(1) or one_per_id(rows))
    rows = [tx(transaction_id=f"t{k}") for k in range(5)]
    store.append_new("raw", frame(spark, rows[:2]))
    process_batch(frame(spark, rows), store, CONFIG, START).release()
    assert not grouped and store.read("raw").count() == 5
    store.append_new("raw", frame(spark, rows + rows + [tx(transaction_id=None), tx(transaction_id="t9")]))
    process_batch(frame(spark, rows + rows), store, CONFIG, START).release()
    assert len(grouped) == 2 and store.read("raw").count() == 6 and store.read_rejected().count() == 1


def test_a_batch_is_computed_once(spark, store):
    """The text of a stream is parsed once, whatever is written from it."""
    seen = spark.sparkContext.accumulator(0)
    rows = frame(spark, [tx(transaction_id="a"), tx(transaction_id="b"), tx(transaction_id=None)]).coalesce(1)

    def counted(batches):
        for part in batches:
            seen.add(part.num_rows)
            yield part

    process_batch(rows.mapInArrow(counted, rows.schema), store, CONFIG, START).release()
    assert seen.value == 3 and store.read("raw").count() == 2 and store.read_rejected().count() == 1
