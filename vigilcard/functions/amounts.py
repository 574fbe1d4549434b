"""Spending-profile expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zscore(amount: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in standard deviations; 0 when mean or deviation is not positive."""
    return F.when((mean > 0) & (std > 0), (amount - mean) / std).otherwise(F.lit(0.0))


def zscore_guarded(amount: Column, mean: Column, std: Column) -> Column:
    """As :func:`zscore`, but also 0 for a deviation under 0.001 or for non-finite inputs."""
    inf = F.lit(float("inf"))
    finite = ~F.isnan(mean) & ~F.isnan(std) & (mean < inf) & (std < inf)
    return F.when(finite & (mean > 0) & (std >= 0.001), (amount - mean) / std).otherwise(F.lit(0.0))


def ratio_to_mean(amount: Column, mean: Column) -> Column:
    """Amount over mean, 1 when the mean is not positive."""
    return F.when(mean > 0, amount / mean).otherwise(F.lit(1.0))


def unusual_amount(
    amount: Column, mean: Column, std: Column, zscore_min: float = 3.0, ratio_min: float = 1.5
) -> Column:
    """Whether either the guarded z-score or the ratio reaches its limit."""
    far = zscore_guarded(amount, mean, std) >= F.lit(zscore_min)
    return far | (ratio_to_mean(amount, mean) >= F.lit(ratio_min))


def mean_and_deviation(df: DataFrame, key: str, amount: str = "amount") -> DataFrame:
    """Mean and sample deviation per key; 0 without values, and no deviation of one value."""
    return df.groupBy(key).agg(
        F.coalesce(F.avg(amount), F.lit(0.0)).alias("amount_mean"),
        F.coalesce(F.stddev_samp(amount), F.lit(0.0)).alias("amount_std"),
    )
