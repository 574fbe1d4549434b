"""Card-transaction fraud analytics expressed as Spark DataFrame, SQL and streaming plans."""

from vigilcard.config import EngineConfig, default_config, load_config
from vigilcard.plans.scoring import score_transactions

__all__ = ["EngineConfig", "default_config", "load_config", "score_transactions"]
