"""Batches that are killed, and the id index of raw."""

import pytest
from pyspark.sql.types import StructType
from rows import START, frame, tx

from vigilcard.schemas import PROFILE, RAW
from vigilcard.sources import layers, levels
from vigilcard.sources.layers import LayerStore
from vigilcard.sources.levels import Levels
from vigilcard.sources.manifest import Files, Manifest

IDS = StructType([RAW["transaction_id"]])


class Killed(Exception):
    pass


def write_all(spark, store, rows, end=None):
    """All writes of a batch; the process ends behind write number ``end``."""
    profiles = rows.selectExpr("card_id", "customer_id", "timestamp AS last_timestamp", "merchant_city AS last_city",
                               "terminal_id AS last_terminal", "device_id AS last_device", "amount AS last_amount",
                               "0D AS risk_score", "'approve' AS risk_level", "timestamp AS updated_at")
    late = spark.createDataFrame([("id",)], "transaction_id string")
    steps = [
        lambda: store.append_rejected(late, "test"),
        lambda: store.append_new("raw", rows),
        lambda: store.add_late_rows(rows, None),
        lambda: store.append_audit(late.selectExpr("'decision' AS event", "transaction_id")),
        lambda: store.write_profiles(profiles),
    ]
    with store.batch("stream"):
        for k, step in enumerate(steps):
            if k == end:
                raise Killed
            step()


def content(store):
    snapshot = store.snapshot_before(2**40)
    tables = [store.read("raw"), store.read_audit(), store.read_rejected(), store.read_profiles(), store.indexed_ids(), snapshot.last_card]
    return [0 if t is None else t.count() for t in tables]


def test_a_killed_batch_is_whole_or_absent(spark, tmp_path):
    root = str(tmp_path / "layers")
    store = LayerStore(spark, root)
    store.append_new("raw", frame(spark, [tx(transaction_id="old", card_id="1")]))
    store.write_snapshot((START.replace(day=START.day + 1)).date())
    before, rows = content(store), frame(spark, [tx(transaction_id=f"t{k}", card_id=f"{k}") for k in range(4)])
    with pytest.raises(Killed):
        write_all(spark, LayerStore(spark, root), rows, 1)
    for end in (2, 3, 4):
        assert content(store) == before
        assert store.roll_back("another") == 0 and store.roll_back("stream") == 1
        assert content(store) == before
        with pytest.raises(Killed):
            write_all(spark, LayerStore(spark, root), rows, end)
    write_all(spark, LayerStore(spark, root), rows)
    assert content(store) == [5, 1, 1, 4, 5, 5]
    assert Files(spark).names(f"{root}/_pending") == []


def test_the_next_batch_of_an_owner_takes_its_remains_back(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rows = frame(spark, [tx(transaction_id="a")])
    with pytest.raises(Killed), store.batch("q"):
        store.append_new("raw", rows)
        raise Killed
    assert store.read("raw").count() == 0
    with store.batch("q"):
        store.append_new("raw", rows)
    assert store.read("raw").count() == store.indexed_ids().count() == 1


def test_few_ids_open_few_files_of_a_large_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(levels, "PER_TASK", 200_000)
    index = Levels(spark, str(tmp_path), IDS, "transaction_id")
    index.add(spark.range(10_000_000).selectExpr("concat('tx', id) AS transaction_id"), "b-1")
    asked = spark.range(9_999_700, 10_000_700).selectExpr("concat('tx', id) AS transaction_id")
    near = index.near(asked)
    assert len(near.inputFiles()) < 0.3 * len(index.read().inputFiles())
    assert near.join(asked, "transaction_id", "left_semi").count() == 300


def test_levels_merge_and_hide(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(levels, "FAN", 2)
    monkeypatch.setattr(levels, "PLAIN", 3)
    monkeypatch.setattr(levels, "PER_BUCKET", 1)
    index = Levels(spark, str(tmp_path), IDS, "transaction_id")
    assert index.read().count() == 0
    for k in range(7):
        index.add(spark.range(k, k + 2).selectExpr("string(id) AS transaction_id"), f"b-{k}")
        index.merge(frozenset({"b-6"}))
    hidden = frozenset({"b-6"})
    assert sorted(r[0] for r in index.read(hidden).distinct().collect()) == [str(k) for k in range(7)]
    assert len(index.entries()) <= 5 and index.read().distinct().count() == 8
    index.forget("b-6")
    asked = spark.createDataFrame([("0",), ("6",), ("7",), ("x",)], "transaction_id string")
    found = index.near(asked).join(asked, "transaction_id", "left_semi").distinct()
    assert sorted(r[0] for r in found.collect()) == ["0", "6"]


def test_an_older_raw_layer_is_indexed_on_demand(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    dated = frame(spark, [tx(transaction_id="a")]).selectExpr("*", "to_date(timestamp) AS dt", "'b-0' AS batch")
    dated.write.partitionBy("dt", "batch").parquet(store.path("raw"))
    rows = frame(spark, [tx(transaction_id="a", amount=9.0), tx(transaction_id="b")])
    store.append_new("raw", rows)
    assert store.read("raw").count() == 2 and store.indexed_ids().count() == 0
    store.rebuild_id_index()
    store.append_new("raw", rows)
    assert store.read("raw").count() == store.indexed_ids().count() == 2


def test_manifest_keeps_few_versions(spark, tmp_path):
    manifest = Manifest(Files(spark), str(tmp_path / "m"))
    assert manifest.entries() == []
    for k in range(9):
        manifest.change(lambda entries, k=k: [*entries, k])
    assert manifest.entries() == list(range(9))
    assert len(Files(spark).names(str(tmp_path / "m"))) == 4


def test_profile_folders_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "PROFILE_DELTAS", 2)
    store = LayerStore(spark, str(tmp_path))
    profiles = spark.createDataFrame([("c", "k", START, None, None, None, 1.0, 0.0, "approve", START)], PROFILE)
    for _ in range(10):
        store.write_profiles(profiles)
    assert store.read_profiles().count() == 1
    assert len([n for n in Files(spark).names(store.path("profiles")) if n != "index"]) <= 7
