"""Column functions on literal inputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilcard.functions import amounts, cards, geo
from vigilcard.functions.merchants import with_merchant_label


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "card, expected",
    [("4532011234567890", "453201"), ("45-32 01/99", "453201"), ("ABCDEFGH", "ABCDEF"), ("12", "12"), (None, None)],
)
def test_bin_from_card(spark, card, expected):
    assert value(spark, cards.bin_from_card(F.lit(card).cast("string"))) == expected


@pytest.mark.parametrize("code, expected", [("7995", True), (" 6051 ", True), ("5411", False), (None, False), ("", False)])
def test_high_risk_merchant(spark, code, expected):
    assert value(spark, cards.high_risk_merchant(F.lit(code).cast("string"))) is expected
    assert value(spark, cards.high_risk_merchant(F.lit("5411"), ["5411"])) is True


def test_haversine_between_cities(spark):
    distance = geo.haversine_km(F.lit(-23.5505), F.lit(-46.6333), F.lit(-22.9068), F.lit(-43.1729))
    assert 340 < value(spark, distance) < 380
    assert value(spark, geo.haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0))) is None


def test_city_distance(spark):
    rows = [("São Paulo", "Rio de Janeiro"), ("Nowhere", "São Paulo"), (None, "São Paulo"), ("Manaus", "Manaus")]
    df = geo.with_city_distance(spark.createDataFrame(rows, "a string, b string"), "a", "b", "km")
    km = {r["a"]: r["km"] for r in df.collect()}
    assert 340 < km["São Paulo"] < 380
    assert km["Nowhere"] == km[None] == km["Manaus"] == 0.0
    assert df.columns == ["a", "b", "km"]


@pytest.mark.parametrize("km, minutes, expected", [(500.0, 30.0, 1000.0), (500.0, 0.0, 0.0), (500.0, None, 0.0)])
def test_speed(spark, km, minutes, expected):
    assert value(spark, geo.speed_kmh(F.lit(km), F.lit(minutes).cast("double"))) == expected


@pytest.mark.parametrize("km, speed, expected", [(800.0, 2400.0, True), (100.0, 50.0, False), (30.0, 1800.0, False)])
def test_impossible_travel(spark, km, speed, expected):
    assert value(spark, geo.impossible_travel(F.lit(km), F.lit(speed))) is expected


@pytest.mark.parametrize("std, expected", [(50.0, 4.0), (0.0, 0.0)])
def test_zscore(spark, std, expected):
    arguments = (F.lit(300.0), F.lit(100.0), F.lit(std))
    assert value(spark, amounts.zscore(*arguments)) == expected
    assert value(spark, amounts.zscore_guarded(*arguments)) == expected


def test_zscore_guard(spark):
    tiny = (F.lit(300.0), F.lit(100.0), F.lit(0.0005))
    assert value(spark, amounts.zscore(*tiny)) > 0
    assert value(spark, amounts.zscore_guarded(*tiny)) == 0.0
    assert value(spark, amounts.zscore_guarded(F.lit(1.0), F.lit(float("nan")), F.lit(1.0))) == 0.0


def test_ratio(spark):
    assert value(spark, amounts.ratio_to_mean(F.lit(350.0), F.lit(100.0))) == 3.5
    assert value(spark, amounts.ratio_to_mean(F.lit(350.0), F.lit(0.0))) == 1.0


@pytest.mark.parametrize("amount, expected", [(400.0, True), (110.0, False)])
def test_unusual_amount(spark, amount, expected):
    assert value(spark, amounts.unusual_amount(F.lit(amount), F.lit(100.0), F.lit(50.0))) is expected


def test_mean_and_deviation(spark):
    rows = [("a", 100.0)] * 4 + [("b", 7.0), ("c", None)]
    df = amounts.mean_and_deviation(spark.createDataFrame(rows, "k string, amount double"), "k")
    assert {r["k"]: (r["amount_mean"], r["amount_std"]) for r in df.collect()} == {
        "a": (100.0, 0.0),
        "b": (7.0, 0.0),
        "c": (0.0, 0.0),
    }


@pytest.mark.parametrize("hour, expected", [(2, True), (5, True), (8, False), (14, False)])
def test_untrusted_hour(spark, hour, expected):
    assert value(spark, cards.untrusted_hour(F.lit(hour))) is expected


def test_dormancy(spark):
    early, late = F.lit(datetime(2025, 1, 1)), F.lit(datetime(2025, 8, 1))
    days = cards.days_since(late, early)
    assert value(spark, days) > 200
    assert value(spark, cards.dormant(days)) is True
    assert value(spark, cards.dormant(F.lit(180.0))) is False
    assert value(spark, cards.days_since(late, F.lit(None).cast("timestamp"))) == 0.0
    assert value(spark, cards.days_since(early, late)) < 0
    assert value(spark, cards.minutes_since(early, late)) == 0.0


@pytest.mark.parametrize(
    "count, window, limit, expected",
    [(6, 60, 5, True), (3, 60, 5, False), (5, 600, None, True), (59, 1, None, False), (60, 1, None, True), (None, 60, None, False)],
)
def test_high_velocity(spark, count, window, limit, expected):
    assert value(spark, cards.high_velocity(F.lit(count).cast("long"), window, limit)) is expected


def test_monotonic_counts(spark):
    assert value(spark, cards.monotonic_counts(*[F.lit(n) for n in (2, 4, 10, 15)])) is True
    assert value(spark, cards.monotonic_counts(*[F.lit(n) for n in (5, 4, 10, 15)])) is False


@pytest.mark.parametrize(
    "now, before, expected", [("D1", "D2", True), ("D1", "D1", False), (None, "D1", False), ("D1", "", False)]
)
def test_two_devices(spark, now, before, expected):
    assert value(spark, cards.two_devices(F.lit(now).cast("string"), F.lit(before))) is expected


def test_merchant_label(spark):
    rows = [("M1", "5411"), ("M2", "5411"), ("M3", "9999"), ("M4", None)]
    df = spark.createDataFrame(rows, "merchant_id string, merchant_category string")
    names = spark.createDataFrame([("M1", "Mercado")], "merchant_id string, merchant_name string")
    expected = {"M1": "Mercado", "M2": "Supermarket", "M3": "M3", "M4": "M4"}
    for dimension in (names, names.limit(1)):
        labels = with_merchant_label(df, dimension)
        assert {r["merchant_id"]: r["merchant_label"] for r in labels.collect()} == expected


def test_time_text(spark):
    whole, parts = F.lit(datetime(2026, 3, 10, 14)), F.lit(datetime(2026, 3, 10, 14, 0, 0, 1500))
    assert value(spark, cards.time_text(whole, "T")) == "2026-03-10T14:00:00"
    assert value(spark, cards.time_text(parts, " ")) == "2026-03-10 14:00:00.001500"
    assert value(spark, cards.time_text(F.lit(None).cast("timestamp"), " ")) is None
