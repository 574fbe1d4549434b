"""Compaction of the dates of a layer: bounded folders, the same rows, killed runs."""

from datetime import timedelta

import pytest
from rows import START, frame, tx

from vigilcard.sources.layers import LayerStore
from vigilcard.sources.manifest import Files


def append(spark, store, k, days=(0,)):
    store.append_new("raw", frame(spark, [tx(transaction_id=f"{k}-{d}", timestamp=None if d is None else START + timedelta(days=d)) for d in days]))


def folders(spark, store):
    """Folders per date that readers see or that wait for their deletion."""
    found = Files(spark).matching(f"{store.path('raw')}/dt=*/batch=*")
    return [p.split("/dt=")[1] for p in found]


def ids(store):
    return sorted(r[0] for r in store.read("raw").select("transaction_id").collect())


def test_many_batches_leave_few_folders(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    for k in range(12):
        append(spark, store, k, (0, 1, None))
        store.compact("raw", 2)
        assert store.read("raw").count() == 3 * (k + 1)
    store.compact("raw", 2)  # takes away what the last one replaced
    counts = {}
    for folder in folders(spark, store):
        counts[folder.split("/")[0]] = counts.get(folder.split("/")[0], 0) + 1
    assert len(counts) == 3 and max(counts.values()) <= 2  # 12 = 8 + 4
    assert ids(store) == sorted(f"{k}-{d}" for k in range(12) for d in (0, 1, None))
    assert store.read("raw").filter("dt IS NULL").count() == 12
    # Ids that lie in compacted folders are still known.
    append(spark, store, 3, (0, 1, None))
    assert store.read("raw").count() == 36


def test_full_dates_alone_are_rewritten(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    assert store.compact("raw") == 0
    for k in range(3):
        append(spark, store, k, (0, 1) if k else (0,))
    assert store.compact("raw", 3) == 3
    assert sum("/batch=g1-" in f for f in folders(spark, store)) == 1
    assert len(ids(store)) == 5


def test_readers_see_whole_layers_around_a_killed_compaction(spark, tmp_path, monkeypatch):
    store = LayerStore(spark, str(tmp_path))
    for k in range(3):
        append(spark, store, k)
    before = ids(store)
    other = LayerStore(spark, str(tmp_path))
    monkeypatch.setattr(other, "_swap", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        other.compact("raw", 2)
    assert len(folders(spark, store)) == 4 and ids(store) == before  # written, not shown
    listed = store.read("raw")
    assert store.compact("raw", 2) == 3
    assert ids(store) == before
    assert listed.count() == 3  # what was listed before the swap is still there
    store.compact("raw", 2)
    assert len(folders(spark, store)) == 1 and ids(store) == before


def test_two_compactions_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    store, other = LayerStore(spark, str(tmp_path)), LayerStore(spark, str(tmp_path))
    for k in range(2):
        append(spark, store, k)
    write = store._write_dated

    def overtaken(layer, rows):
        write(layer, rows)
        other.compact(layer, 2)

    monkeypatch.setattr(store, "_write_dated", overtaken)
    with pytest.raises(RuntimeError, match="same time"):
        store.compact("raw", 2)
    assert ids(store) == ["0-0", "1-0"]


def test_pending_batches_are_left_alone(spark, tmp_path):
    store, writer = LayerStore(spark, str(tmp_path)), LayerStore(spark, str(tmp_path))
    for k in range(2):
        append(spark, store, k)
    with writer.batch("q"):
        append(spark, writer, 2)
        assert store.compact("raw", 2) == 2
        assert ids(store) == ["0-0", "1-0"]
    assert ids(store) == ["0-0", "1-0", "2-0"]
