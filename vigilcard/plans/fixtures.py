"""Derives card transactions from a generic ``events`` table.

The table has columns ``event_id, ts, user_id, event_type, value``; every formula below is a
plain expression, so the derivation is one narrow projection on top of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.schemas import FRAUD_LABELS, RAW

# The lists the derivation draws from and the date that splits it.
BINS = ("453201", "402400", "455187", "525400")
CATEGORIES = ("5411", "5812", "5814", "5311", "5732", "5912", "5541", "7995", "6051", "5816", "5999", "5944")
CITY_NAMES = (
    "São Paulo",
    "Rio de Janeiro",
    "Belo Horizonte",
    "Salvador",
    "Recife",
    "Curitiba",
    "Porto Alegre",
    "Brasília",
    "Manaus",
    "Natal",
    "Fortaleza",
)
SPLIT = "2024-01-20 00:00:00"
SPLIT_EPOCH = 1705708800


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _code(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived transactions in the raw layout."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp").alias("ts"), "user_id", "event_type", "value"
    )
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    hour = F.lit(3_600_000_000)
    micros = F.unix_micros("ts")
    packed = micros - micros % hour + F.floor((micros % hour) / F.lit(6))
    helped = events.select(
        "*",
        F.timestamp_micros(packed.cast("long")).alias("ts1"),
        F.when(user % 5 == 0, event % 2).otherwise(F.lit(0)).alias("cardno"),
    )
    cardno = F.col("cardno")
    idle = ((user % 10 == 5) & (cardno == 1)) | ((user % 10 == 7) & (cardno == 0))
    early = F.col("ts1") < F.timestamp_seconds(F.lit(SPLIT_EPOCH))
    amount = (
        F.when(event % 12 == 5, F.lit(1) + F.floor(value) / F.lit(100))
        .when(event % 31 == 0, value * 90)
        .otherwise(value * 4 + 20)
    )
    tens = event % 10
    entry_mode = F.when(
        user % 4 == 0,
        F.when(event % 97 == 0, "magnetic").when(tens < 7, "chip").otherwise("contactless"),
    ).otherwise(
        F.when(tens < 6, "chip").when(tens < 8, "contactless").when(tens == 8, "magnetic").otherwise("ecommerce")
    )
    device = (
        F.when(event % 4 == 0, F.lit(None))
        .when(
            (event % 53 == 1) | ((event % 31 == 0) & (event % 2 == 1)),
            F.concat(F.lit("DVR-NEW-"), event.cast("string")),
        )
        .otherwise(F.concat_ws("-", F.lit("DVR"), user.cast("string"), (event % 2).cast("string")))
    )
    columns = {
        "transaction_id": _code("tx_", event, 12),
        "customer_id": _code("C", user, 6),
        "card_id": F.concat(_pick(BINS, user % 4), F.lpad((user * 2 + cardno).cast("string"), 10, "0")),
        "timestamp": F.when(early & idle, F.timestamp_micros(F.unix_micros("ts1") - 200 * 86_400_000_000)).otherwise(F.col("ts1")),
        "amount": F.round(amount, 2),
        "currency": F.lit("BRL"),
        "merchant_id": _code("M", event % 248, 5),
        "merchant_category": _pick(CATEGORIES, event % 12),
        "merchant_city": F.when(event % 9 == 0, _pick(CITY_NAMES, event % 11)).otherwise(_pick(CITY_NAMES, user % 8)),
        "merchant_country": F.lit("BR"),
        "terminal_id": _code("T", event % 40, 7),
        "entry_mode": entry_mode,
        "device_id": device,
        "channel": F.when(tens == 9, "online").when(event % 23 == 0, "atm").otherwise("pos"),
        "auth_result": F.when(F.col("event_type") == "error", "declined").otherwise("approved"),
    }
    return helped.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW.fields])


def history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Transactions before the split date, and from it on."""
    rows = transactions(spark, sf_dir)
    split = F.timestamp_seconds(F.lit(SPLIT_EPOCH))
    return rows.filter(F.col("timestamp") < split), rows.filter(F.col("timestamp") >= split)


def fraud_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth for nine of ten derived transactions; the others have no label."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    event = F.col("event_id")
    kind = (
        F.when(event % 31 == 0, "unusual_amount").when(event % 9 == 0, "impossible_travel").otherwise("none")
    )
    labels = events.filter(event % 10 != 3).select(
        _code("tx_", event, 12).alias("transaction_id"), (kind != "none").alias("is_fraud"), kind.alias("fraud_type")
    )
    return labels.select(*FRAUD_LABELS.names)


def merchant_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names of every fifth merchant, so that all ways of labelling occur."""
    merchants = transactions(spark, sf_dir).select("merchant_id").distinct()
    number = F.substring("merchant_id", 2, 5).cast("int")
    return merchants.filter(number % 5 == 0).select(
        "merchant_id", F.concat(F.lit("Loja "), number.cast("string")).alias("merchant_name")
    )
