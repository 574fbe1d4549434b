"""Each rule on literal features, scores and decision limits."""

import pytest
from pyspark.sql import functions as F

from vigilcard.config import config_from_dict, default_config, load_config
from vigilcard.functions.cards import is_blank
from vigilcard.operators.decisions import risk_level, with_decision
from vigilcard.operators.rules import RULES, active_rules, fired_entries, needed_families, register_rule, with_conditions

CONFIG = default_config()

CALM = {
    "transaction_id": "t1",
    "card_id": "4532019999999999",
    "amount": 25.0,
    "merchant_city": "São Paulo",
    "entry_mode": "chip",
    "device_id": "D1",
    "count_10min": 0,
    "min_10min": 0.0,
    "minutes_since_last": 500.0,
    "prev_merchant_city": "São Paulo",
    "new_terminal": False,
    "new_device": False,
    "new_city": False,
    "entry_mode_chip_only_history": False,
    "amount_mean_90d": 30.0,
    "amount_count_90d": 20,
    "amount_zscore": 0.0,
    "amount_vs_avg_ratio": 1.0,
    "distance_from_last_km": 0.0,
    "travel_speed_kmh": 0.0,
    "dormant_days": 0.5,
    "hour_of_day": 12,
    "bin_denials_15min": 0,
    "prev_bin_approved": True,
}
SCHEMA = (
    "transaction_id string, card_id string, amount double, merchant_city string, entry_mode string, device_id string, "
    "count_10min long, min_10min double, minutes_since_last double, prev_merchant_city string, new_terminal boolean, "
    "new_device boolean, new_city boolean, entry_mode_chip_only_history boolean, amount_mean_90d double, "
    "amount_count_90d long, amount_zscore double, amount_vs_avg_ratio double, distance_from_last_km double, "
    "travel_speed_kmh double, dormant_days double, hour_of_day long, bin_denials_15min long, prev_bin_approved boolean"
)

PROBE = dict(amount=1500.0, count_10min=2, min_10min=5.0, minutes_since_last=3.0, new_terminal=True)
STRIPE = dict(amount=200.0, entry_mode="magnetic", entry_mode_chip_only_history=True)
TRAVEL = dict(merchant_city="Manaus", distance_from_last_km=2690.0, travel_speed_kmh=16140.0, minutes_since_last=10.0)
AMOUNT = dict(amount=2500.0, amount_zscore=6.0, amount_vs_avg_ratio=5.0, amount_mean_90d=500.0)
DEVICE = dict(amount=1800.0, device_id="DEV-9", new_device=True, amount_mean_90d=200.0)
DORMANT = dict(amount=2200.0, dormant_days=210.0, amount_mean_90d=400.0)
BIN = dict(bin_denials_15min=4, prev_bin_approved=False)
NIGHT = dict(amount=350.0, merchant_city="Fortaleza", hour_of_day=3, new_city=True)

CASES = [
    ({}, None, None),
    (PROBE, "card_cloning", "teste R$ 5.00 seguido de R$ 1500.00 em 3min (2 tx em 10min)"),
    ({**PROBE, "prev_merchant_city": None, "merchant_city": None}, "card_cloning", "teste R$ 5.00"),
    ({**PROBE, "prev_merchant_city": None, "merchant_city": None, "new_terminal": False}, None, None),
    ({**PROBE, "prev_merchant_city": "Recife"}, None, None),
    ({**PROBE, "minutes_since_last": 0.0}, None, None),
    ({**PROBE, "minutes_since_last": None}, None, None),
    ({**PROBE, "min_10min": 10.0}, None, None),
    ({**PROBE, "amount": 24.9}, None, None),
    (STRIPE, "card_cloning", "tarja magnética em cartão com histórico 100% chip (R$ 200.00)"),
    ({**STRIPE, "amount": 29.9}, None, None),
    ({**STRIPE, "entry_mode_chip_only_history": False}, None, None),
    (TRAVEL, "impossible_travel", "São Paulo → Manaus (2690 km em 10min = 16140 km/h)"),
    ({**TRAVEL, "travel_speed_kmh": 900.0}, None, None),
    ({**TRAVEL, "distance_from_last_km": 49.9}, None, None),
    (AMOUNT, "unusual_amount", "valor R$ 2500.00 fora do padrão histórico (z=6.0, média R$ 500.00)"),
    ({**AMOUNT, "amount_count_90d": 4}, None, None),
    ({**AMOUNT, "amount_vs_avg_ratio": 3.9}, None, None),
    (DEVICE, "new_device_high_amount", "nunca visto (DEV-9) com valor R$ 1800.00 (9.0x a média R$ 200.00)"),
    ({**DEVICE, "device_id": None}, None, None),
    ({**DEVICE, "device_id": ""}, None, None),
    ({**DEVICE, "new_device": False}, None, None),
    ({**DEVICE, "amount": 800.0}, None, None),
    (DORMANT, "dormant_card_wake", "cartão inativo 210 dias: transação de R$ 2200.00 (5.5x média R$ 400.00)"),
    ({**DORMANT, "amount_mean_90d": 0.0}, "dormant_card_wake", "reativação com valor R$ 2200.00"),
    ({**DORMANT, "amount_mean_90d": 0.0, "amount": 999.0}, None, None),
    ({**DORMANT, "dormant_days": 180.0}, None, None),
    (BIN, "bin_attack", "4 negadas em 453201 nos últimos 15min sem aprovação prévia"),
    ({**BIN, "bin_denials_15min": 2}, None, None),
    ({**BIN, "prev_bin_approved": True}, None, None),
    (NIGHT, "unusual_hour_and_place", "transação na madrugada (3h) em cidade não habitual (Fortaleza)"),
    ({**NIGHT, "hour_of_day": 5}, None, None),
    ({**NIGHT, "prev_merchant_city": None}, None, None),
    ({**NIGHT, "prev_merchant_city": "Fortaleza"}, None, None),
]


def features(spark, cases):
    rows = [{**CALM, **changes, "transaction_id": str(n)} for n, changes in enumerate(cases)]
    return spark.createDataFrame([tuple(r[c] for c in CALM) for r in rows], SCHEMA)


def test_rule_table(spark):
    df = with_decision(features(spark, [c[0] for c in CASES]), CONFIG, F.current_timestamp())
    got = {int(r["transaction_id"]): r for r in df.collect()}
    for n, (changes, rule, reason) in enumerate(CASES):
        row = got[n]
        assert row["triggered_rules"] == ([rule] if rule else []), changes
        assert row["risk_score"] == (CONFIG.rule(rule).weight if rule else 0.0)
        if reason:
            assert reason in row["rule_reasons"][0]


def test_weights_add_up_and_are_capped(spark):
    cases = [{**TRAVEL, **BIN}, {**BIN, **AMOUNT}, {**AMOUNT, "new_device": True}]
    df = with_decision(features(spark, cases), CONFIG, F.current_timestamp())
    got = [(r["risk_score"], r["risk_level"], r["triggered_rules"]) for r in df.orderBy("transaction_id").collect()]
    assert got == [
        (100.0, "block", ["impossible_travel", "bin_attack"]),
        (100.0, "block", ["unusual_amount", "bin_attack"]),
        (80.0, "block", ["unusual_amount", "new_device_high_amount"]),
    ]


@pytest.mark.parametrize(
    "score, level",
    [(0, "approve"), (25, "approve"), (29.9, "approve"), (30, "review"), (55, "review"), (69.9, "review"),
     (70, "block"), (85, "block"), (100, "block")],
)
def test_decision_limits(spark, score, level):
    column = risk_level(F.lit(float(score)), CONFIG.thresholds)
    assert spark.range(1).select(column.alias("v")).first()["v"] == level


def test_only_enabled_and_known_rules_run(spark):
    raw = {"rules": {"bin_attack": {"weight": 10}, "no_such_rule": {}, "unusual_amount": {"enabled": False}}}
    config = config_from_dict(raw)
    assert [r.name for r in active_rules(config)] == ["bin_attack"]
    assert needed_families(config) == ("bin",)
    df = with_decision(features(spark, [{**BIN, **AMOUNT}]), config, F.current_timestamp())
    assert df.first()["risk_score"] == 10.0


def test_no_rules_at_all(spark):
    config = config_from_dict({})
    df = with_decision(features(spark, [BIN]), config, F.current_timestamp())
    row = df.first()
    assert (row["risk_score"], row["triggered_rules"], row["risk_level"]) == (0.0, [], "approve")


def test_registering_a_rule(spark):
    @register_rule("no_device", needs=())
    def no_device(settings):
        return is_blank(F.col("device_id")), F.lit("sem dispositivo")

    try:
        config = config_from_dict({"rules": {"no_device": {"weight": 31}}})
        judged, flags = with_conditions(features(spark, [{}, {"device_id": None}]), config)
        hits = judged.select("transaction_id", F.inline(fired_entries(flags))).filter("rule_name IS NOT NULL")
        assert [tuple(r) for r in hits.collect()] == [("1", "no_device", 31.0, "sem dispositivo")]
    finally:
        del RULES["no_device"]


def test_settings_file(tmp_path):
    yaml_file = tmp_path / "settings.yaml"
    yaml_file.write_text(
        "model_version: 2.0\nthresholds: {review_from: 20}\nscoring: {max_score: 90}\n"
        "merchant_risk: {high_risk_categories: []}\n"
        "rules:\n  bin_attack: {weight: 12, params: {min_denials: 5}}\n  card_cloning: {enabled: false}\n",
        encoding="utf-8",
    )
    config = load_config(yaml_file)
    assert config.model_version == "2.0"
    assert (config.thresholds.review_from, config.thresholds.block_from) == (20, 70)
    assert config.max_score == 90.0
    assert config.high_risk_categories == default_config().high_risk_categories
    assert [r.name for r in config.rules] == ["bin_attack", "card_cloning"]
    assert config.rule("bin_attack").params["min_denials"] == 5
    assert config.rule("card_cloning").weight == 30.0
    assert load_config(tmp_path / "missing.yaml").rules == ()
    json_file = tmp_path / "settings.json"
    json_file.write_text('{"rules": {"bin_attack": {}}}', encoding="utf-8")
    assert [r.name for r in load_config(json_file).rules] == ["bin_attack"]
