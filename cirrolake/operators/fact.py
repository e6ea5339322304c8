"""The hourly fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cirrolake.functions import calendar as cal
from cirrolake.functions.measures import mean, total
from cirrolake.operators.dimensions import location_key, weather_key
from cirrolake.schemas import FACT_HOURLY_WEATHER

KEYS = ["location_key", "date_key", "weather_key", "observation_hour"]


def _measures(scale: int | None) -> list[Column]:
    return [
        mean("temperature", scale).alias("avg_temperature_celsius"),
        mean("apparent_temperature", scale).alias("avg_feels_like_celsius"),
        mean("humidity", scale).alias("avg_humidity_percent"),
        F.max("wind_speed").alias("max_wind_speed_ms"),
        mean("cloud_cover", scale).alias("avg_cloud_coverage_percent"),
        total("precipitation", scale).alias("total_precipitation_mmh"),
        F.count("id").alias("observation_count"),
    ]


def fact_hourly_weather(
    silver: DataFrame,
    dim_location: DataFrame,
    dim_date: DataFrame,
    dim_weather: DataFrame,
    scale: int | None = None,
) -> DataFrame:
    """Silver aggregated by the dimensions' keys and the hour; a row without a match has a null key.

    The joins carry no hint: Spark broadcasts a dimension while its size stays below the session's threshold, by
    statistics or at run time, and else joins by shuffle with hot places split.
    """
    s = silver.withColumn("_day", F.to_date("observed_at"))
    l = dim_location.select("location_key", F.col("place").alias("_place"))
    d = dim_date.select("date_key", F.col("full_date").alias("_full_date"))
    w = dim_weather.select("weather_key", F.col("weather_code").alias("_code"), F.col("weather_description").alias("_text"))
    # Plain equality: a null code or description finds no weather row.
    return (
        s.join(l, s.place == l._place, "left")
        .join(d, s._day == d._full_date, "left")
        .join(w, (s.weather_code == w._code) & (s.weather_description == w._text), "left")
        .groupBy(*KEYS)
        .agg(*_measures(scale))
        .select(*FACT_HOURLY_WEATHER.names)
    )


def fact_from_same_silver(silver: DataFrame, scale: int | None = None) -> DataFrame:
    """The same fact when the dimensions come from this very Silver, without any join.

    Every place, date and weather pair of Silver is then in its dimension, and keys are functions of those values, so
    looking them up can only give what is computed here.
    """
    code, text = F.col("weather_code"), F.col("weather_description")
    keyed = silver.select(
        F.when(F.col("place").isNotNull(), location_key(F.col("place"))).alias("location_key"),
        cal.date_key(F.to_date("observed_at")).alias("date_key"),
        F.when(code.isNotNull() & text.isNotNull(), weather_key(code, text)).alias("weather_key"),
        "observation_hour",
        "temperature",
        "apparent_temperature",
        "humidity",
        "wind_speed",
        "cloud_cover",
        "precipitation",
        "id",
    )
    return keyed.groupBy(*KEYS).agg(*_measures(scale)).select(*FACT_HOURLY_WEATHER.names)
