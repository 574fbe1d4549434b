"""Merchant display names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labels of merchant categories without a merchant name.
CATEGORY_LABELS = {"5411": "Supermarket", "5812": "Restaurant", "5814": "Fast Food"}



def with_merchant_label(df: DataFrame, names: DataFrame) -> DataFrame:
    """Adds ``merchant_label``: the merchant's name, else its category label, else its id.

    ``names`` has columns ``merchant_id, merchant_name``; Spark picks the join by its size.
    """
    dimension = names.select("merchant_id", "merchant_name")
    pairs = [F.lit(text) for pair in CATEGORY_LABELS.items() for text in pair]
    by_category = F.try_element_at(F.create_map(*pairs), F.coalesce("merchant_category", F.lit("")))
    label = F.coalesce(F.col("merchant_name"), by_category, F.col("merchant_id"))
    return df.join(dimension, "merchant_id", "left").withColumn("merchant_label", label).drop("merchant_name")
