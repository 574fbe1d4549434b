"""Fraud rules as Column expressions.

A rule is a function ``(settings) -> (condition, reason)`` over unrounded features; an
enabled rule adds its weight to the score when its condition holds. More rules can be
registered with :func:`register_rule`. No rule needs Python at run time.
"""

from __future__ import annotations

from typing import Any, Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilcard.config import EngineConfig, RuleSettings
from vigilcard.functions.cards import BIN_LENGTH

Rule = Callable[[RuleSettings], tuple[Column, Column]]
RULES: dict[str, Rule] = {}

# Feature families a rule reads; a plan for chosen rules computes no others.
FAMILIES = ("card", "customer", "bin", "novelty")
NEEDS: dict[str, tuple[str, ...]] = {}

# Reason texts.
REASON_PROBE = "teste R$ %.2f seguido de R$ %.2f em %.0fmin (%d tx em 10min)"
REASON_STRIPE = "tarja magnética em cartão com histórico 100%% chip (R$ %.2f)"
REASON_AMOUNT = "valor R$ %.2f fora do padrão histórico (z=%.1f, média R$ %.2f)"
REASON_TRAVEL = "deslocamento impossível: %s → %s (%.0f km em %.0fmin = %.0f km/h)"
REASON_DEVICE = "dispositivo nunca visto (%s) com valor R$ %.2f (%.1fx a média R$ %.2f)"
REASON_DORMANT = "cartão inativo %d dias: transação de R$ %.2f (%.1fx média R$ %.2f)"
REASON_REACTIVATED = "cartão inativo %d dias: reativação com valor R$ %.2f"
REASON_BIN = "%d negadas em %s nos últimos 15min sem aprovação prévia"
REASON_NIGHT = "transação na madrugada (%dh) em cidade não habitual (%s)"


def register_rule(name: str, needs: tuple[str, ...] = FAMILIES) -> Callable[[Rule], Rule]:
    """Makes a rule available to configurations under ``name``."""

    def add(rule: Rule) -> Rule:
        RULES[name] = rule
        NEEDS[name] = needs
        return rule

    return add


def _param(settings: RuleSettings, key: str, default: Any) -> float:
    return float(settings.params.get(key, default))


def _says(text: str, *arguments: str) -> Column:
    return F.expr(f"format_string('{text}', {', '.join(arguments)})")


# Names used in the conditions below.
AMOUNT = "coalesce(amount, 0D)"
HAS_DEVICE = "coalesce(device_id, '') <> ''"
HAS_PREVIOUS_CITY = "coalesce(prev_merchant_city, '') <> ''"


@register_rule("card_cloning", needs=("card", "novelty"))
def card_cloning(settings: RuleSettings) -> tuple[Column, Column]:
    """A small probe followed by a large purchase, or a stripe on a chip-only card."""
    small = _param(settings, "test_amount_max", 10.0)
    probe = f"""
        count_10min >= 1 AND min_10min > 0 AND min_10min < {small}D
        AND {AMOUNT} >= min_10min * {_param(settings, "follow_ratio", 5.0)}D
        AND minutes_since_last > 0 AND minutes_since_last <= {_param(settings, "follow_window_min", 10)}D"""
    stripe = f"entry_mode = 'magnetic' AND entry_mode_chip_only_history AND {AMOUNT} > 0"
    in_place = f"prev_merchant_city <=> merchant_city AND (new_terminal OR {HAS_PREVIOUS_CITY}) AND {AMOUNT} > 0"
    after_probe = f"({probe}) AND (({in_place}) OR ({stripe}))"
    reason = F.when(
        F.expr(after_probe), _says(REASON_PROBE, "min_10min", AMOUNT, "minutes_since_last", "count_10min")
    ).otherwise(_says(REASON_STRIPE, AMOUNT))
    return F.expr(f"({after_probe}) OR ({stripe} AND {AMOUNT} >= {3 * small}D)"), reason


@register_rule("unusual_amount", needs=("customer",))
def unusual_amount(settings: RuleSettings) -> tuple[Column, Column]:
    """An amount far above the customer's 90-day profile."""
    condition = f"""
        amount_count_90d >= {int(_param(settings, "min_history_txs", 5))}
        AND {AMOUNT} >= {_param(settings, "min_amount", 800.0)}D
        AND amount_zscore >= {_param(settings, "zscore_min", 5.5)}D
        AND amount_vs_avg_ratio >= {_param(settings, "ratio_min", 4.0)}D"""
    return F.expr(condition), _says(REASON_AMOUNT, AMOUNT, "amount_zscore", "amount_mean_90d")


@register_rule("impossible_travel", needs=("card",))
def impossible_travel(settings: RuleSettings) -> tuple[Column, Column]:
    """Two cities too far apart for the time between two transactions."""
    condition = f"""
        distance_from_last_km >= {_param(settings, "min_distance_km", 50.0)}D
        AND travel_speed_kmh > 0 AND travel_speed_kmh > {_param(settings, "speed_limit_kmh", 900.0)}D"""
    cities = ("prev_merchant_city", "merchant_city")
    return F.expr(condition), _says(
        REASON_TRAVEL, *cities, "distance_from_last_km", "minutes_since_last", "travel_speed_kmh"
    )


@register_rule("new_device_high_amount", needs=("customer", "novelty"))
def new_device(settings: RuleSettings) -> tuple[Column, Column]:
    """A device nobody saw on this card before, with an amount far above the mean."""
    condition = f"""
        new_device AND {HAS_DEVICE} AND {AMOUNT} > {_param(settings, "min_amount", 800.0)}D
        AND amount_mean_90d > 0 AND {AMOUNT} > amount_mean_90d * {_param(settings, "amount_ratio", 4.0)}D"""
    times = f"{AMOUNT} / nullif(amount_mean_90d, 0D)"
    return F.expr(condition), _says(REASON_DEVICE, "device_id", AMOUNT, times, "amount_mean_90d")


@register_rule("dormant_card_wake", needs=("card", "customer"))
def dormant_wake(settings: RuleSettings) -> tuple[Column, Column]:
    """A long idle card with sudden spending."""
    floor = _param(settings, "min_amount", 500.0)
    asleep = f"dormant_days > {_param(settings, 'dormant_days', 180)}D AND {AMOUNT} > {floor}D"
    above_mean = f"amount_mean_90d > 0 AND {AMOUNT} > amount_mean_90d * {_param(settings, 'amount_ratio', 2.0)}D"
    no_profile = f"amount_mean_90d <= 0 AND {AMOUNT} >= {2 * floor}D"
    days, times = "bigint(dormant_days)", f"{AMOUNT} / nullif(amount_mean_90d, 0D)"
    reason = F.when(F.expr(above_mean), _says(REASON_DORMANT, days, AMOUNT, times, "amount_mean_90d")).otherwise(
        _says(REASON_REACTIVATED, days, AMOUNT)
    )
    return F.expr(f"{asleep} AND (({above_mean}) OR ({no_profile}))"), reason


@register_rule("bin_attack", needs=("bin",))
def bin_attack(settings: RuleSettings) -> tuple[Column, Column]:
    """Several recent denials on one BIN without an approval just before."""
    condition = f"bin_denials_15min >= {int(_param(settings, 'min_denials', 3))} AND NOT prev_bin_approved"
    prefix = f"coalesce(substring(card_id, 1, {BIN_LENGTH}), '')"
    return F.expr(condition), _says(REASON_BIN, "bin_denials_15min", prefix)


@register_rule("unusual_hour_and_place", needs=("card", "novelty"))
def night_place(settings: RuleSettings) -> tuple[Column, Column]:
    """A night purchase in a city the card was never used in."""
    start, end = (int(_param(settings, f"untrusted_hour_{side}", hour)) for side, hour in (("start", 2), ("end", 4)))
    condition = f"""
        {AMOUNT} >= {_param(settings, "min_amount", 150.0)}D AND hour_of_day BETWEEN {start} AND {end}
        AND new_city AND {HAS_PREVIOUS_CITY} AND NOT (prev_merchant_city <=> merchant_city)"""
    return F.expr(condition), _says(REASON_NIGHT, "hour_of_day", "coalesce(merchant_city, 'None')")


def active_rules(config: EngineConfig) -> list[RuleSettings]:
    """Enabled rules that are registered, in configuration order."""
    return [r for r in config.rules if r.enabled and r.name in RULES]


def needed_families(config: EngineConfig) -> tuple[str, ...]:
    """Feature families the active rules read."""
    read = {family for r in active_rules(config) for family in NEEDS[r.name]}
    return tuple(family for family in FAMILIES if family in read)


def with_conditions(features: DataFrame, config: EngineConfig) -> tuple[DataFrame, list[tuple[str, RuleSettings]]]:
    """Adds one boolean per active rule; returns their names with the rules' settings.

    Conditions are evaluated once here; score, names and reasons then read the booleans.
    """
    flags = [(f"_fires_{n}", settings) for n, settings in enumerate(active_rules(config))]
    conditions = {flag: F.coalesce(RULES[s.name](s)[0], F.lit(False)) for flag, s in flags}
    return (features.withColumns(conditions) if conditions else features), flags


def total_weight(flags: list[tuple[str, RuleSettings]]) -> Column:
    """Sum of the weights of the rules that fire."""
    terms = [f"CASE WHEN {flag} THEN {float(settings.weight)}D ELSE 0D END" for flag, settings in flags]
    return F.expr(" + ".join(terms) or "0D")


def _of_fired(flags: list[tuple[str, RuleSettings]], value) -> Column:
    """Array of one value per rule that fires, in configuration order.

    Most rows fire nothing, so they take the empty array. Dropping the nulls is a
    higher-order function, which also keeps the reason texts out of the generated method:
    with them it would grow beyond what the JVM compiles.
    """
    none = F.expr("CAST(array() AS array<string>)")
    if not flags:
        return none
    any_fires = F.expr(" OR ".join(flag for flag, _ in flags))
    values = F.array(*[F.when(F.col(flag), value(settings)) for flag, settings in flags])
    return F.when(any_fires, F.array_compact(values)).otherwise(none)


def fired_names(flags: list[tuple[str, RuleSettings]]) -> Column:
    """Names of the rules that fire."""
    return _of_fired(flags, lambda settings: F.lit(settings.name))


def fired_reasons(flags: list[tuple[str, RuleSettings]]) -> Column:
    """Reasons of the rules that fire."""
    return _of_fired(flags, lambda settings: RULES[settings.name](settings)[1])


def fired_entries(flags: list[tuple[str, RuleSettings]]) -> Column:
    """Array with (rule_name, weight, reason) for each active rule, null where it does not fire."""
    entries = [
        F.when(
            F.col(flag),
            F.struct(
                F.lit(settings.name).alias("rule_name"),
                F.lit(float(settings.weight)).alias("weight"),
                RULES[settings.name](settings)[1].alias("reason"),
            ),
        )
        for flag, settings in flags
    ]
    return F.array(*entries).cast("array<struct<rule_name:string,weight:double,reason:string>>")
