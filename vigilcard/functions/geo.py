"""City coordinates, great-circle distance and travel speed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Mean Earth radius (km) and the coordinates of the known cities.
EARTH_RADIUS_KM = 6371.0088
CITIES = (
    ("São Paulo", -23.5505, -46.6333),
    ("Rio de Janeiro", -22.9068, -43.1729),
    ("Belo Horizonte", -19.9167, -43.9345),
    ("Salvador", -12.9714, -38.5014),
    ("Recife", -8.0476, -34.8770),
    ("Fortaleza", -3.7319, -38.5267),
    ("Curitiba", -25.4284, -49.2733),
    ("Porto Alegre", -30.0346, -51.2177),
    ("Manaus", -3.1190, -60.0217),
    ("Brasília", -15.8267, -47.9218),
    ("Goiânia", -16.6869, -49.2648),
    ("Belém", -1.4558, -48.4902),
    ("Campinas", -22.9094, -47.0626),
    ("Santos", -23.9608, -46.3336),
    ("Florianópolis", -27.5945, -48.5477),
    ("Natal", -5.7793, -35.2009),
    ("João Pessoa", -7.1195, -34.8450),
    ("Cuiabá", -15.6014, -56.0979),
    ("Ribeirão Preto", -21.1775, -47.8103),
    ("Uberlândia", -18.9186, -48.2772),
    ("Londrina", -23.3107, -51.1628),
    ("Teresina", -5.0892, -42.8019),
    ("São Luís", -2.5307, -44.3068),
    ("Vitória", -20.3155, -40.3128),
    ("Campo Grande", -20.4697, -54.6201),
    ("Aracaju", -10.9472, -37.0731),
    ("Maceió", -9.6660, -35.7350),
    ("Manaus Metropolitan", -3.1019, -60.0250),
    ("Pelotas", -31.7650, -52.3377),
    ("Santarém", -2.4431, -54.7083),
    ("Foz do Iguaçu", -25.5163, -54.5854),
)


def city_table(spark: SparkSession) -> DataFrame:
    """The known cities as an inline relation ``(city, lat, lon)``."""
    values = ", ".join(f"('{city}', {lat}D, {lon}D)" for city, lat, lon in CITIES)
    return spark.sql(f"SELECT * FROM VALUES {values} AS cities(city, lat, lon)")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres; null when a coordinate is."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # least/greatest skip nulls, so the clamp is applied to a known chord only.
    clamped = F.when(chord.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), chord)))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped))


def with_city_distance(df: DataFrame, city_a: str, city_b: str, name: str) -> DataFrame:
    """Adds the distance between two city columns, 0 when either city is not known.

    The city table has a fixed size (31 rows), so both lookups are broadcast joins.
    """
    cities = city_table(df.sparkSession)
    out = df
    for side, column in (("a", city_a), ("b", city_b)):
        known = cities.select(
            F.col("city").alias(f"_city_{side}"), F.col("lat").alias(f"_lat_{side}"), F.col("lon").alias(f"_lon_{side}")
        )
        out = out.join(F.broadcast(known), F.col(column) == F.col(f"_city_{side}"), "left")
    distance = haversine_km(F.col("_lat_a"), F.col("_lon_a"), F.col("_lat_b"), F.col("_lon_b"))
    helpers = [f"_{part}_{side}" for part in ("city", "lat", "lon") for side in "ab"]
    return out.withColumn(name, F.coalesce(distance, F.lit(0.0))).drop(*helpers)


def speed_kmh(distance_km: Column, minutes: Column) -> Column:
    """Distance over elapsed time, 0 when no time passed or none is known."""
    return F.when(minutes > 0, distance_km / (minutes / F.lit(60.0))).otherwise(F.lit(0.0))


def impossible_travel(
    distance_km: Column, speed: Column, limit_kmh: float = 900.0, min_distance_km: float = 50.0
) -> Column:
    """Whether a long enough trip was faster than the limit."""
    return (distance_km >= F.lit(min_distance_km)) & (speed > F.lit(limit_kmh))
