"""Window features, predecessors and novelty against a row-by-row model."""

import statistics
from datetime import timedelta

import pytest
from rows import START, _epoch, collect, frame, model, random_rows, tx

from vigilcard.config import default_config
from vigilcard.operators import seconds
from vigilcard.plans.scoring import transaction_features

CONFIG = default_config()


def check(spark, batch, history, since=None, ended=False):
    past = None if history is None else frame(spark, history)
    df = transaction_features(frame(spark, batch), past, CONFIG, since, ended)
    expected = {r["transaction_id"]: model(r, batch + (history or []), history or []) for r in batch}
    got = collect(df, *next(iter(expected.values())))
    assert len(got) == len(batch)
    for id_, features in expected.items():
        if history is None:
            features = {**features, "entry_mode_chip_only_history": False}
            features.update(new_terminal=True, new_device=True, new_city=True)
        wanted = {k: pytest.approx(v, abs=1e-6) if isinstance(v, float) else v for k, v in features.items()}
        assert got[id_] == {"transaction_id": id_, **wanted}, id_


@pytest.mark.parametrize("seed", [1, 2])
def test_no_history(spark, seed):
    check(spark, random_rows(seed, 150), None)


@pytest.mark.parametrize("seed", [3, 4])
def test_history_before_batch(spark, seed):
    rows = sorted(random_rows(seed, 220), key=_epoch)
    while _epoch(rows[149]) == _epoch(rows[150]):
        rows.pop(150)
    batch, history = rows[150:], rows[:150]
    check(spark, batch, history, since=_epoch(batch[0]), ended=True)


@pytest.mark.parametrize("with_bound", [True, False])
def test_history_around_batch(spark, with_bound):
    """Late rows: history holds rows after, and in the same second as, rows of the batch."""
    rows = random_rows(5, 260, days=20)
    batch, history = rows[:90], rows[90:]
    since = min(_epoch(r) for r in batch) if with_bound else None
    check(spark, batch, history, since=since)


def test_empty_history_differs_from_none(spark):
    check(spark, random_rows(6, 30), [])


def test_long_idle_gap_and_slot_borders(spark):
    """Predecessors many slots back, frames that start exactly on a slot border."""
    midnight = START.replace(hour=0)
    times = [0, 1, 86399, 86400, 86401, 172800, 400 * 86400, 400 * 86400 + 60, 490 * 86400, 490 * 86400 + 60]
    rows = [
        tx(transaction_id=f"t{n}", timestamp=midnight + timedelta(seconds=s), amount=10.0 + n)
        for n, s in enumerate(times)
    ]
    check(spark, rows, None)
    check(spark, rows[6:], rows[:6], since=_epoch(rows[6]), ended=True)


def test_equal_amounts_have_no_deviation(spark):
    rows = [tx(transaction_id=f"t{n}", timestamp=START + timedelta(days=n), amount=4.35) for n in range(40)]
    df = transaction_features(frame(spark, rows), None, CONFIG)
    assert {r["amount_std_90d"] for r in df.collect()} == {0.0}


def test_row_without_time_is_kept(spark):
    rows = [tx(), tx(transaction_id="t2", timestamp=None)]
    df = transaction_features(frame(spark, rows), None, CONFIG)
    got = collect(df, "velocity_24h", "hour_of_day", "minutes_since_last", "dormant_days")
    assert got["t2"] == {
        "transaction_id": "t2",
        "velocity_24h": 0,
        "hour_of_day": 0,
        "minutes_since_last": None,
        "dormant_days": 0.0,
    }


def test_hot_card_plan_has_bounded_groups(spark):
    """Every frame group is a (key, slot) or a (key, second), never a whole key of rows."""
    df = transaction_features(frame(spark, [tx()]), frame(spark, [tx(transaction_id="h")]), CONFIG)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    whole_key = [line for line in windows if "lag(latest" not in line and "slot#" not in line and "ts_epoch#" not in line]
    assert windows and not whole_key


@pytest.mark.parametrize("rate,most", [(1, 255), (2, 3)])
def test_ranges_of_a_second_give_the_same_rows_before(spark, monkeypatch, rate, most):
    """Every id, or each second one, is a border; history shares seconds with the batch."""
    monkeypatch.setattr(seconds, "BORDER_RATE", rate)
    monkeypatch.setattr(seconds, "MOST_BORDERS", most)
    rows = random_rows(7, 200, days=20)
    check(spark, rows[:90], rows[90:])
    check(spark, [tx(transaction_id=f"t{n:03d}", amount=1.0 + n, timestamp=START + timedelta(microseconds=n)) for n in range(60)], None)


def test_a_hot_second_is_spread_over_tasks(spark):
    """A second with half of all rows is ordered in several groups of several partitions."""
    many = spark.range(80_000).selectExpr(
        "concat('t', lpad(id, 6, '0')) AS transaction_id", "IF(id % 2 = 0, 'hot', concat('c', id)) AS card_key", "7L AS ts_epoch")
    borders = seconds._borders(many, "card_key")
    found = seconds._in_ranges(many, borders, "card_key", "left").filter("card_key = 'hot'").groupBy("id_range").count().collect()
    assert borders.count() == 1 and len(found) >= 5
    assert sum(r["count"] for r in found) == 40_000 and max(r["count"] for r in found) < 20_000


@pytest.mark.parametrize("base", [1e4, 1e6, 1e7, 1e8])
def test_deviation_of_large_amounts(spark, base):
    """Amounts close together around a large one, after ninety days of small ones."""
    old = [tx(transaction_id=f"o{n}", timestamp=START - timedelta(days=150 - n), amount=1.0 + n) for n in range(20)]
    near = [base + 0.01 * (n % 3) for n in range(10)]
    rows = [tx(transaction_id=f"t{n}", timestamp=START + timedelta(minutes=n // 2), amount=a) for n, a in enumerate(near)]
    last = tx(transaction_id="last", timestamp=START + timedelta(hours=1), amount=base)
    got = collect(transaction_features(frame(spark, [*old, *rows, last]), None, CONFIG), "amount_std_90d", "amount_mean_90d")
    assert got["last"]["amount_std_90d"] == pytest.approx(statistics.stdev(near), rel=1e-6)
    assert got["last"]["amount_mean_90d"] == pytest.approx(statistics.fmean(near), rel=1e-12)


def test_wide_rows_are_shuffled_once(spark):
    """Only one exchange carries a column that no feature needs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = transaction_features(frame(spark, [tx()]), frame(spark, [tx(transaction_id="h")]), CONFIG)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sections = [s for s in text.split("\n\n") if s.startswith("(") and ") Exchange" in s.splitlines()[0]]
    assert sections and sum("merchant_country" in s for s in sections) == 1
