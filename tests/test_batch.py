"""Whole batches: decisions on hand-made rows, layers, reprocessing, audit, exports and profiles."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import START, frame, random_rows, tx

from vigilcard.config import default_config
from vigilcard.operators import decisions
from vigilcard.operators.profiles import card_profiles, merge_profiles
from vigilcard.plans import partials
from vigilcard.plans.batch import backfill, first_transactions, process_batch
from vigilcard.plans.partials import FROM_PARTIALS
from vigilcard.plans.reports import REPORTS, run_query
from vigilcard.schemas import ALERT, ENRICHED, PROFILE
from vigilcard.sources.layers import LayerStore
from vigilcard.sources.scratch import scratch_dir

CONFIG = default_config()
NOW = datetime(2026, 4, 1)
CLONE_PAIR = [
    tx(transaction_id="c1", amount=4.5, entry_mode="magnetic", device_id=None),
    tx(transaction_id="c2", amount=2800.0, entry_mode="magnetic", device_id=None, timestamp=START + timedelta(minutes=4)),
]
TRAVEL_PAIR = [
    tx(transaction_id="v1", card_id="4532012222222222", customer_id="C2"),
    tx(transaction_id="v2", card_id="4532012222222222", customer_id="C2", merchant_city="Manaus",
       timestamp=START + timedelta(minutes=12)),
]
BAKERY = tx(transaction_id="b1", card_id="4532015555555555", customer_id="C3", amount=32.5,
            entry_mode="contactless", timestamp=START.replace(hour=8, minute=30))


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "layers"))


def decided(result):
    return {r["transaction_id"]: r for r in result.enriched.collect()}


def test_hand_made_cases(spark, store):
    rows = frame(spark, CLONE_PAIR + TRAVEL_PAIR + [BAKERY])
    got = decided(process_batch(rows, store, CONFIG, NOW, write=False))
    assert got["c2"]["risk_level"] == "block" and got["c2"]["risk_score"] >= 70
    assert "card_cloning" in got["c2"]["triggered_rules"]
    assert got["v2"]["risk_level"] == "block"
    assert "impossible_travel" in got["v2"]["triggered_rules"]
    assert got["b1"]["risk_level"] == "approve" and got["b1"]["triggered_rules"] == []
    assert store.read("raw") is None


def test_never_seen_card_by_stripe_is_blocked_once_history_exists(spark, store):
    stripe = tx(transaction_id="s1", card_id="9999990000000001", entry_mode="magnetic", amount=30.0)
    assert decided(process_batch(frame(spark, [stripe]), store, CONFIG, NOW, write=False))["s1"]["risk_score"] == 0.0
    store.append_new("raw", frame(spark, [BAKERY]))
    got = decided(process_batch(frame(spark, [stripe]), store, CONFIG, NOW, write=False))
    assert got["s1"]["triggered_rules"] == ["card_cloning"]


def test_reprocessing_changes_no_layer(spark, store):
    rows = frame(spark, CLONE_PAIR + CLONE_PAIR + [BAKERY])
    for _ in range(2):
        result = process_batch(rows, store, CONFIG, NOW)
        assert result.stats().first().asDict() == {
            "processed": 3, "alerts": 1, "approve": 2, "review": 0, "block": 1, "avg_score": 25.0,
        }
        assert [tuple(r) for r in result.rule_counts().collect()] == [("card_cloning", 1)]
        result.release()
    assert store.read("raw").count() == store.read("enriched").count() == 3
    assert store.read("alerts").count() == 1
    assert store.read_audit().count() == 6
    assert store.read_profiles().count() == 2


def test_stored_tables_have_the_fixed_layout(spark, store):
    process_batch(frame(spark, CLONE_PAIR), store, CONFIG, NOW).release()
    assert store.read("enriched").columns == [*ENRICHED.names, "dt"]
    alert = store.read("alerts")
    assert alert.columns == [*ALERT.names, "dt"]
    assert alert.first()["bin"] == "453201"
    snapshot = alert.select(F.from_json("feature_snapshot", "map<string,string>").alias("m")).first()["m"]
    assert len(snapshot) == 32 and snapshot["prev_ts"] == "2026-03-10 14:00:00"
    assert store.read_profiles().columns == PROFILE.names


def test_date_filter_prunes_partitions(spark, store):
    rows = [tx(transaction_id=f"t{n}", timestamp=START + timedelta(days=n)) for n in range(3)]
    store.append_new("raw", frame(spark, rows))
    chosen = store.read("raw").filter(F.col("dt") >= F.lit("2026-03-12").cast("date"))
    assert "PartitionFilters: [isnotnull(dt" in chosen._jdf.queryExecution().executedPlan().toString()
    assert [r["transaction_id"] for r in chosen.collect()] == ["t2"]


def test_audit_events(spark, store):
    process_batch(frame(spark, CLONE_PAIR), store, CONFIG, NOW).release()
    event = store.read_audit().filter("transaction_id = 'c2'").first()
    assert (event["event"], event["timestamp"], event["risk_level"]) == ("decision", "2026-03-10 14:04:00", "block")
    assert event["audit_ts"] == "2026-04-01T00:00:00+00:00"
    alert = decisions.alert_audit_events(store.read("alerts"), decisions.timestamp_literal(NOW)).first()
    assert alert["event"] == "alert" and alert["transaction_id"] == "c2"


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_export(spark, store, tmp_path, fmt):
    process_batch(frame(spark, CLONE_PAIR), store, CONFIG, NOW).release()
    target = str(tmp_path / "out")
    store.export("alerts", target, fmt)
    reader = spark.read.option("header", True).option("escape", '"') if fmt == "csv" else spark.read
    row = getattr(reader, fmt)(target).first()
    rules = row["triggered_rules"]
    assert rules == ('["card_cloning"]' if fmt == "csv" else ["card_cloning"])
    assert "tarja" in str(row["rule_reasons"]) or "teste" in str(row["rule_reasons"])


def test_export_errors(store):
    with pytest.raises(ValueError):
        store.export("raw", "/tmp/x", "xml")
    with pytest.raises(LookupError):
        store.export("raw", "/tmp/x", "csv")


def test_reports_run_on_empty_and_filled_layers(spark, store):
    for name in REPORTS:
        assert run_query(spark, store, name).count() >= 0
    process_batch(frame(spark, CLONE_PAIR + [BAKERY]), store, CONFIG, NOW).release()
    labels = [("c2", True, "card_cloning"), ("b1", False, "none")]
    store.write_labels(spark.createDataFrame(labels, "transaction_id string, is_fraud boolean, fraud_type string"))
    effect = run_query(spark, store, "rule_effectiveness").first()
    assert (effect["rule_name"], effect["true_positives"], effect["precision_pct"]) == ("card_cloning", 1, 100.0)
    false = run_query(spark, store, "false_positives_by_rule").first()
    assert (false["false_positive_count"], false["false_positive_rate_on_normal_pct"]) == (0, 0.0)
    assert run_query(spark, store, "SELECT count(*) AS n FROM enriched").first()["n"] == 3
    with pytest.raises(ValueError):
        run_query(spark, store, "no_such_report")


def test_reports_from_partials_equal_the_direct_ones(spark, store):
    process_batch(frame(spark, CLONE_PAIR), store, CONFIG, NOW).release()
    assert store.read_report_partials() is None
    store.keep_report_partials()
    untimed = tx(transaction_id="u", timestamp=None, amount=None, merchant_category=None)
    for _ in range(2):  # what is delivered again adds nothing
        process_batch(frame(spark, [BAKERY, untimed]), store, CONFIG, NOW).release()
    kept = store.read_report_partials()
    assert kept.agg({"n": "sum"}).first()[0] == 4
    enriched = store.read("enriched")
    for name in FROM_PARTIALS:
        assert run_query(spark, store, name).collect() == REPORTS[name][1](enriched).collect()
    assert partials.batch_stats(kept).collect() == decisions.batch_stats(enriched).collect()
    store.keep_report_partials()
    assert store.read_report_partials().agg({"n": "sum"}).first()[0] == 4


def test_partials_of_a_store_without_rows(spark, store):
    store.keep_report_partials()
    assert run_query(spark, store, "volume_by_hour").count() == 0
    process_batch(frame(spark, CLONE_PAIR), store, CONFIG, NOW).release()
    assert run_query(spark, store, "volume_by_hour").agg({"total_transactions": "sum"}).first()[0] == 2


def test_no_normal_transactions_gives_no_rate(spark, store):
    process_batch(frame(spark, CLONE_PAIR), store, CONFIG, NOW).release()
    labels = [("c1", True, "card_cloning"), ("c2", True, "card_cloning")]
    store.write_labels(spark.createDataFrame(labels, "transaction_id string, is_fraud boolean, fraud_type string"))
    assert run_query(spark, store, "false_positives_by_rule").first()["false_positive_rate_on_normal_pct"] is None


def test_backfill_limit_is_in_time_order(spark, store, tmp_path):
    rows = [tx(transaction_id=f"t{n}", timestamp=START - timedelta(minutes=n)) for n in range(5)]
    source = str(tmp_path / "source")
    frame(spark, rows).write.parquet(source)
    result = backfill(spark, source, store, CONFIG, limit=2, decision_ts=NOW)
    assert sorted(decided(result)) == ["t3", "t4"]
    assert first_transactions(frame(spark, rows)).count() == 5


@pytest.mark.parametrize("limit", [1, 2, 7, 23, 40, 59, 60, 99])
def test_first_rows_are_those_of_a_full_sort(spark, limit):
    moments = [None, None, *[START + timedelta(days=k % 3, seconds=k % 4, microseconds=k % 2) for k in range(58)]]
    rows = [tx(transaction_id=f"t{n * 7 % 60:02}", timestamp=m) for n, m in enumerate(moments)]
    expected = sorted(rows, key=lambda r: (r["timestamp"] is not None, r["timestamp"] or START, r["transaction_id"]))[:limit]
    found = first_transactions(frame(spark, rows), limit)
    assert sorted(r.transaction_id for r in found.collect()) == sorted(r["transaction_id"] for r in expected)


def test_profiles_keep_last_present_values(spark):
    rows = [
        tx(transaction_id="a", device_id="D1", amount=1.0),
        tx(transaction_id="b", device_id=None, amount=2.0, merchant_city="Recife", timestamp=START + timedelta(hours=1)),
        tx(transaction_id="x", card_id=None),
    ]
    scored = frame(spark, rows).withColumns({"risk_score": F.lit(5.0), "risk_level": F.lit("approve")})
    now = F.lit(NOW)
    first = card_profiles(scored, now)
    got = first.collect()
    assert len(got) == 1
    assert (got[0]["last_device"], got[0]["last_city"], got[0]["last_amount"]) == ("D1", "Recife", 2.0)

    late = [tx(transaction_id="c", device_id="D9", merchant_city="Manaus", timestamp=START + timedelta(minutes=5))]
    late_scored = frame(spark, late).withColumns({"risk_score": F.lit(9.0), "risk_level": F.lit("approve")})
    merged = merge_profiles(first, card_profiles(late_scored, now)).first()
    assert (merged["last_city"], merged["last_device"], merged["risk_score"]) == ("Recife", "D1", 5.0)


def test_history_regimes_through_the_store(spark, store):
    """Processing in two batches sees the first batch as history."""
    rows = sorted(random_rows(11, 80, days=10), key=lambda r: r["timestamp"])
    first, second = rows[:40], rows[40:]
    process_batch(frame(spark, first), store, CONFIG, NOW).release()
    result = process_batch(frame(spark, second), store, CONFIG, NOW)
    got = decided(result)
    seen = {(r["card_id"], r["device_id"]) for r in first}
    for r in second:
        known = r["card_id"] is not None and r["device_id"] is not None and (r["card_id"], r["device_id"]) in seen
        assert got[r["transaction_id"]]["new_device"] is not known


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
