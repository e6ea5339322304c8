"""The three dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cirrolake.functions import calendar as cal
from cirrolake.functions.keys import surrogate_key
from cirrolake.operators.dedupe import first_per_key, total_order
from cirrolake.schemas import DIM_DATE, DIM_LOCATION, DIM_WEATHER


def location_key(place: Column) -> Column:
    return surrogate_key(place)


def weather_key(code: Column, description: Column) -> Column:
    # Adding zero turns -0.0 into 0.0, which equals it in joins and groups but has another text.
    return surrogate_key(code.cast("double") + F.lit(0.0), description)


#: A place's attributes, and the columns that say which of its rows is the latest.
LOCATION_ATTRIBUTES = ["place", "api_city", "country", "latitude", "longitude"]
LOCATION_ROW = [*LOCATION_ATTRIBUTES, "ingested_at", "observed_at", "id"]


def latest_rows(rows: DataFrame) -> DataFrame:
    """Of each place the row that was last ingested; then the last observed, then the smallest id."""
    seen = rows.where(F.col("place").isNotNull()).select(*LOCATION_ROW)
    order = total_order(
        seen,
        F.col("ingested_at").desc_nulls_last(),
        F.col("observed_at").desc_nulls_last(),
        F.col("id").asc_nulls_last(),
    )
    return first_per_key(seen, ["place"], order)


def keyed_locations(latest: DataFrame) -> DataFrame:
    return latest.select(location_key(F.col("place")).alias("location_key"), *LOCATION_ATTRIBUTES).select(*DIM_LOCATION.names)


def dim_location(silver: DataFrame) -> DataFrame:
    """Per place the attributes it was last ingested with."""
    return keyed_locations(latest_rows(silver))


def dim_date(silver: DataFrame, ts: str = "observed_at") -> DataFrame:
    """One row per date that has observations."""
    return keyed_dates(silver.select(F.to_date(ts).alias("full_date")).distinct())


def keyed_dates(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        cal.date_key(day).alias("date_key"),
        day,
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        cal.month_name(day).alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        cal.day_of_week_sun_0(day).alias("day_of_week_sun_0"),
        cal.day_name(day).alias("day_name"),
        cal.is_weekend(day).alias("is_weekend"),
    ).select(*DIM_DATE.names)


def dim_weather(silver: DataFrame) -> DataFrame:
    """One row per pair of code and description, a pair of nulls included."""
    return keyed_weathers(silver.select("weather_code", "weather_description").distinct())


def keyed_weathers(pairs: DataFrame) -> DataFrame:
    pair = [F.col("weather_code"), F.col("weather_description")]
    return pairs.select(weather_key(*pair).alias("weather_key"), *pair).select(*DIM_WEATHER.names)
