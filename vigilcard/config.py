"""Engine settings: thresholds, rule weights and parameters, streaming and window knobs.

Settings become literals inside Column expressions, so changing one changes the plan and
nothing has to be shipped to the executors.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any, Iterable, Mapping

# Default decision thresholds, rule weights and rule parameters.
DEFAULT_THRESHOLDS = {"approve_below": 30, "review_from": 30, "block_from": 70}
DEFAULT_MAX_SCORE = 100.0
DEFAULT_RULE_WEIGHT = 30.0
DEFAULT_RULES: dict[str, dict[str, Any]] = {
    "card_cloning": {
        "weight": 75,
        "params": {"test_amount_max": 10.0, "follow_window_min": 10, "follow_ratio": 5.0},
    },
    "unusual_amount": {
        "weight": 35,
        "params": {"zscore_min": 5.5, "ratio_min": 4.0, "min_amount": 800.0, "min_history_txs": 5},
    },
    "impossible_travel": {
        "weight": 80,
        "params": {"speed_limit_kmh": 900.0, "min_distance_km": 50.0},
    },
    "new_device_high_amount": {
        "weight": 45,
        "params": {"amount_ratio": 4.0, "min_amount": 800.0},
    },
    "dormant_card_wake": {
        "weight": 40,
        "params": {"dormant_days": 180, "amount_ratio": 2.0, "min_amount": 500.0},
    },
    "bin_attack": {
        "weight": 75,
        "params": {"window_min": 15, "min_denials": 3},
    },
    "unusual_hour_and_place": {
        "weight": 50,
        "params": {"untrusted_hour_start": 2, "untrusted_hour_end": 4, "min_amount": 300.0},
    },
}
# Merchant category codes treated as high risk.
DEFAULT_HIGH_RISK_CATEGORIES = ("7995", "7996", "6051", "4829", "5816", "5999", "7800", "6012")


@dataclass(frozen=True)
class Thresholds:
    """Score limits of the approve / review / block decision."""

    approve_below: int = DEFAULT_THRESHOLDS["approve_below"]
    review_from: int = DEFAULT_THRESHOLDS["review_from"]
    block_from: int = DEFAULT_THRESHOLDS["block_from"]


@dataclass(frozen=True)
class RuleSettings:
    """Weight, switch and parameters of one rule."""

    name: str
    enabled: bool = True
    weight: float = DEFAULT_RULE_WEIGHT
    params: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class StreamingSettings:
    """Micro-batch settings."""

    watermark_seconds: int = 600
    processing_time_seconds: int = 1
    checkpoint_dir: str | None = None


@dataclass(frozen=True)
class EngineConfig:
    """Everything a scoring run depends on."""

    model_version: str = "1.0.0"
    thresholds: Thresholds = Thresholds()
    max_score: float = DEFAULT_MAX_SCORE
    streaming: StreamingSettings = StreamingSettings()
    high_risk_categories: tuple[str, ...] = DEFAULT_HIGH_RISK_CATEGORIES
    rules: tuple[RuleSettings, ...] = ()
    bin_window_override: int | None = None

    @property
    def bin_window_seconds(self) -> int:
        """Length of the BIN window: the general setting, else ``window_min`` of ``bin_attack``."""
        if self.bin_window_override is not None:
            return self.bin_window_override
        params = next((r.params for r in self.rules if r.name == "bin_attack"), {})
        return int(float(params.get("window_min", 15)) * 60)

    def rule(self, name: str) -> RuleSettings:
        """Settings of one rule; raises KeyError when it is not configured."""
        for settings in self.rules:
            if settings.name == name:
                return settings
        raise KeyError(name)

    def with_rules(self, names: Iterable[str]) -> "EngineConfig":
        """The same configuration with only the named rules enabled."""
        keep = set(names)
        return replace(self, rules=tuple(replace(r, enabled=r.name in keep) for r in self.rules))

    def with_thresholds(self, review_from: int, block_from: int) -> "EngineConfig":
        """The same configuration with other decision limits."""
        return replace(self, thresholds=Thresholds(review_from, review_from, block_from))


def config_from_dict(raw: Mapping[str, Any]) -> EngineConfig:
    """Builds a configuration from parsed YAML or JSON; rules keep their order of appearance."""
    limits = {**DEFAULT_THRESHOLDS, **(raw.get("thresholds") or {})}
    stream = raw.get("streaming") or {}
    rules = tuple(
        RuleSettings(
            name=name,
            enabled=bool(body.get("enabled", True)),
            weight=float(body.get("weight", DEFAULT_RULE_WEIGHT)),
            params=dict(body.get("params") or {}),
        )
        for name, body in (raw.get("rules") or {}).items()
        if isinstance(body, Mapping)
    )
    categories = (raw.get("merchant_risk") or {}).get("high_risk_categories") or DEFAULT_HIGH_RISK_CATEGORIES
    return EngineConfig(
        model_version=str(raw.get("model_version", "1.0.0")),
        thresholds=Thresholds(*(int(limits[k]) for k in ("approve_below", "review_from", "block_from"))),
        max_score=float((raw.get("scoring") or {}).get("max_score", DEFAULT_MAX_SCORE)),
        streaming=StreamingSettings(
            watermark_seconds=int(stream.get("watermark_seconds", 600)),
            processing_time_seconds=int(stream.get("processing_time_seconds", 1)),
            checkpoint_dir=stream.get("checkpoint_dir"),
        ),
        high_risk_categories=tuple(str(c) for c in categories),
        rules=rules,
        bin_window_override=int(raw["bin_window_seconds"]) if "bin_window_seconds" in raw else None,
    )


def default_config() -> EngineConfig:
    """The stock configuration: seven rules, limits 30 and 70, scores capped at 100."""
    return config_from_dict({"rules": DEFAULT_RULES})


def load_config(path: str | Path) -> EngineConfig:
    """Reads a YAML or JSON settings file. A file that does not exist configures no rules."""
    source = Path(path)
    if not source.exists():
        return config_from_dict({})
    text = source.read_text(encoding="utf-8")
    if source.suffix == ".json":
        return config_from_dict(json.loads(text) or {})
    try:
        import yaml
    except ImportError as exc:  # YAML support is optional
        raise RuntimeError("reading YAML settings needs PyYAML; use a .json file instead") from exc
    return config_from_dict(yaml.safe_load(text) or {})
