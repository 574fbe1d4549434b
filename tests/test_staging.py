"""What many steps read is derived once, and long frames cost linear time."""

import gc
import re
import time
from pathlib import Path

import pytest
from rows import frame, random_rows

from vigilcard import catalog
from vigilcard.config import default_config
from vigilcard.operators.align import align
from vigilcard.operators.seconds import bin_seconds, card_seconds
from vigilcard.plans import batch
from vigilcard.plans.batch import process_batch
from vigilcard.plans.replay import recompute_decisions
from vigilcard.sources import layers
from vigilcard.sources.layers import LayerStore
from vigilcard.sources.scratch import FREE_SHUFFLES, Scratch, freed_shuffles

SF = "/root/testdata/sf0.001"


def test_scoring_reads_the_derived_rows_back(spark):
    files = catalog._scored(spark, SF).inputFiles()
    assert files and not any("events.parquet" in f for f in files)


def test_staged_sides_are_the_derived_ones(spark):
    staged = catalog._staged(spark, SF)
    history, batch = catalog.fixtures.history_and_batch(spark, SF)
    for got, wanted in zip(staged, (history, batch, history.unionByName(batch)), strict=True):
        assert got.columns == wanted.columns
        assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_replay_reads_raw_once(spark):
    raw = Scratch(spark).stage(frame(spark, random_rows(3, 60)), "raw-of-replay")
    ids = raw.select("transaction_id").limit(20)
    files = recompute_decisions(raw, default_config(), catalog.DECIDED_AT, ids).inputFiles()
    assert files and not any("raw-of-replay" in f for f in files)


def test_counts_need_no_sliding_frame(spark):
    rows = align(frame(spark, random_rows(4, 50)))
    rows = rows.selectExpr("*", "true AS is_batch")
    for made, sliding in ((bin_seconds, set()), (card_seconds, {600})):
        plan = made(rows, None)._jdf.queryExecution().optimizedPlan().toString()
        assert {int(n) for n in re.findall(r"RangeFrame, -(\d+)L?, -1", plan)} == sliding


def test_counts_before_1970_and_across_slots(spark):
    """A card's slots begin at whole multiples of eight days on both sides of 1970."""
    for border in (-8 * 86400, 0, 8 * 86400):
        times = [border - 86399, border - 1, border, border + 1]
        rows = spark.createDataFrame([(f"t{n}", t) for n, t in enumerate(times)], "transaction_id string, at long")
        raw = frame(spark, random_rows(1, 1)).drop("transaction_id", "timestamp").crossJoin(
            rows.selectExpr("transaction_id", "timestamp_seconds(at) AS timestamp"))
        made = card_seconds(align(raw).selectExpr("*", "true AS is_batch"), None)
        found = {r["ts_epoch"]: r["velocity_24h"] for r in made.select("ts_epoch", "velocity_24h").collect()}
        assert found == {t: sum(t - 86400 <= u < t for u in times) for t in times}


def _shuffled(spark):
    """Bytes of shuffle files that are on disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for d in folders for f in Path(d).rglob("shuffle_*.data"))


def _events(n, query="q"):
    return "range(%d)" % n, [
        "'decision' AS event", "concat('tx_', lpad(id, 12, '0')) AS transaction_id", "'C000001' AS customer_id",
        "'4532010000000001' AS card_id", "'2026-03-10 14:00:00' AS timestamp", "id * 0.5D AS amount", "0D AS risk_score",
        "'approve' AS risk_level", "array() AS triggered_rules", "array() AS rule_reasons", "'v1' AS model_version",
        "'2026-04-01T00:00:00+00:00' AS audit_ts", f"'{query}' AS query_id", "0L AS epoch"]


def test_shuffles_of_a_batch_do_not_stay(spark, tmp_path):
    """What a batch and its layers have shuffled is gone when they end, and the session is as before."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)  # what other tests have left may go meanwhile
    store = LayerStore(spark, str(tmp_path / "layers"))
    rows = sorted(random_rows(7, 200, days=10), key=lambda r: r["timestamp"])
    setting = spark.conf.get(FREE_SHUFFLES)
    before = _shuffled(spark)
    store.append_new("raw", frame(spark, rows[:80]))
    process_batch(frame(spark, rows), store, default_config(), catalog.DECIDED_AT).release()
    time.sleep(1)
    assert _shuffled(spark) <= before
    assert spark.conf.get(FREE_SHUFFLES) == setting and store.read("enriched").count() == 200


def test_the_setting_comes_back_after_a_failure(spark):
    for value in (None, "false", "true"):
        spark.conf.unset(FREE_SHUFFLES) if value is None else spark.conf.set(FREE_SHUFFLES, value)
        outside = spark.conf.get(FREE_SHUFFLES)
        try:
            with freed_shuffles(spark), freed_shuffles(spark):
                assert spark.conf.get(FREE_SHUFFLES) == "true"
                raise KeyError
        except KeyError:
            assert spark.conf.get(FREE_SHUFFLES) == outside
        finally:
            spark.conf.unset(FREE_SHUFFLES)


def test_audit_lines_are_compressed_and_whole(spark, tmp_path):
    """The log takes a small part of its text, in files of a bounded length; old plain files are read with it."""
    store = LayerStore(spark, str(tmp_path / "layers"))
    table, columns = _events(2500)
    events = spark.sql(f"SELECT * FROM {table}").selectExpr(*columns)
    plain = str(tmp_path / "layers/audit/batch=b-old")
    events.write.option("ignoreNullFields", "false").json(plain)
    with pytest.MonkeyPatch.context() as patch:
        patch.setitem(layers.JSON_LINES, "maxRecordsPerFile", 400)
        store.append_audit(events.coalesce(1))
    made = [f for d in (tmp_path / "layers/audit").iterdir() if d.name != "batch=b-old" for f in d.glob("part-*")]
    text = sum(f.stat().st_size for f in Path(plain).glob("part-*"))
    assert len(made) == 7 and sum(f.stat().st_size for f in made) < text / 5
    read = store.read_audit().select(*events.columns)
    assert read.exceptAll(events.unionAll(events)).isEmpty() and read.count() == 5000


def test_windows_staged_by_family_are_the_same(spark, tmp_path, monkeypatch):
    """A large batch stages each family of windows; with late rows each part stages its own."""
    rows = sorted(random_rows(11, 240, days=10), key=lambda r: r["timestamp"])
    seen, stage = [], Scratch.stage
    monkeypatch.setattr(Scratch, "stage", lambda self, df, name, by=None: seen.append(name) or stage(self, df, name, by))
    found = []
    for most in (batch.BROADCAST_KEYS, 0):
        monkeypatch.setattr(batch, "BROADCAST_KEYS", most)
        store = LayerStore(spark, str(tmp_path / f"layers-{most}"))
        store.append_new("raw", frame(spark, rows[:80]))
        store.write_snapshot(rows[160]["timestamp"].date())
        seen.clear()
        process_batch(frame(spark, rows[80:]), store, default_config(), catalog.DECIDED_AT).release()
        assert seen.count("scored") == 2
        assert [n for n in seen if n.endswith("-features")] == [f"{f}-features" for f in ("card", "customer", "bin")] * (0 if most else 2)
        found.append([store.read(layer).orderBy("transaction_id").collect() for layer in ("enriched", "alerts")])
    assert found[0] == found[1] and len(found[0][0]) == 160
