"""The dashboard's questions on the star schema.

`Gold` names the four tables. Every question takes the dashboard's two filters: `dates`, an inclusive range, and
`places`, a list of names. A filter that is not set is not in the plan.

Questions grouped by a dimension's label aggregate the fact by its key first and look the label up afterwards, so a
hot place is reduced in the tasks that read it and only one partial row per key and task is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cirrolake.functions.measures import total

Dates = tuple[dt.date | None, dt.date | None] | None
Places = Sequence[str] | None


@dataclass(frozen=True)
class Gold:
    dim_location: DataFrame
    dim_date: DataFrame
    dim_weather: DataFrame
    fact_hourly_weather: DataFrame


def _in_dates(day: Column, dates: Dates) -> Column | None:
    if dates is None:
        return None
    low, high = dates
    condition = None
    if low is not None:
        condition = day >= F.lit(low)
    if high is not None:
        condition = day <= F.lit(high) if condition is None else condition & (day <= F.lit(high))
    return condition


def _selected(dimension: DataFrame, dates: Dates, places: Places) -> DataFrame | None:
    """The dimension's rows that the filters keep, or None when no set filter concerns it."""
    condition = _in_dates(F.col("full_date"), dates) if "full_date" in dimension.columns else None
    if "place" in dimension.columns and places is not None:
        condition = F.col("place").isin(list(places))
    return None if condition is None else dimension.where(condition)


def fact_rows(gold: Gold, dates: Dates = None, places: Places = None) -> DataFrame:
    """Fact rows under the filters."""
    fact = gold.fact_hourly_weather
    for dimension, key in ((gold.dim_date, "date_key"), (gold.dim_location, "location_key")):
        kept = _selected(dimension, dates, places)
        if kept is not None:
            fact = fact.join(kept.select(key), key, "left_semi")
    return fact


def total_locations(gold: Gold, places: Places = None) -> DataFrame:
    kept = _selected(gold.dim_location, None, places)
    return (gold.dim_location if kept is None else kept).agg(F.count(F.lit(1)).alias("total_locations"))


def location_map(gold: Gold, places: Places = None) -> DataFrame:
    """Map markers."""
    kept = _selected(gold.dim_location, None, places)
    return (gold.dim_location if kept is None else kept).select("place", "latitude", "longitude")


def _average(measure: str, alias: str, gold: Gold, dates: Dates, places: Places, scale: int | None) -> DataFrame:
    sums = fact_rows(gold, dates, places).agg(total(measure, scale).alias("_s"), F.count(measure).alias("_n"))
    return sums.select((F.col("_s") / F.nullif(F.col("_n"), F.lit(0))).alias(alias))


def average_temperature(gold: Gold, dates: Dates = None, places: Places = None, scale: int | None = None) -> DataFrame:
    return _average("avg_temperature_celsius", "average_temperature", gold, dates, places, scale)


def average_humidity(gold: Gold, dates: Dates = None, places: Places = None, scale: int | None = None) -> DataFrame:
    return _average("avg_humidity_percent", "average_humidity", gold, dates, places, scale)


def average_cloud_coverage(
    gold: Gold, dates: Dates = None, places: Places = None, scale: int | None = None
) -> DataFrame:
    return _average("avg_cloud_coverage_percent", "average_cloud_coverage", gold, dates, places, scale)


def highest_wind(gold: Gold, dates: Dates = None, places: Places = None) -> DataFrame:
    return fact_rows(gold, dates, places).agg(F.max("max_wind_speed_ms").alias("highest_wind"))


def _exact(measure: str, scale: int | None) -> Column:
    """The measure in the type it is summed in."""
    return F.col(measure) if scale is None else F.col(measure).cast(f"decimal(18,{scale})")


def daily_trend(gold: Gold, dates: Dates = None, places: Places = None, scale: int | None = None) -> DataFrame:
    """Average temperature and total precipitation per date."""
    by_key = (
        fact_rows(gold, dates, places)
        .groupBy("date_key")
        .agg(
            F.sum(_exact("avg_temperature_celsius", scale)).alias("_t"),
            F.count("avg_temperature_celsius").alias("_n"),
            F.sum(_exact("total_precipitation_mmh", scale)).alias("_p"),
        )
    )
    labelled = by_key.join(gold.dim_date.select("date_key", "full_date"), "date_key", "left")
    n = F.nullif(F.sum("_n"), F.lit(0))
    return labelled.groupBy("full_date").agg(
        (F.sum("_t").cast("double") / n).alias("avg_temperature"),
        F.sum("_p").cast("double").alias("total_precipitation"),
    )


def by_place(
    gold: Gold, measure: str, how: str, dates: Dates = None, places: Places = None, scale: int | None = None
) -> DataFrame:
    """One measure per place, `how` being "avg" or "max"; fact rows without a place form a group of their own."""
    fact = fact_rows(gold, dates, places).groupBy("location_key")
    if how == "max":
        by_key, final = fact.agg(F.max(measure).alias("_v")), F.max("_v")
    else:
        by_key = fact.agg(F.sum(_exact(measure, scale)).alias("_v"), F.count(measure).alias("_n"))
        final = F.sum("_v").cast("double") / F.nullif(F.sum("_n"), F.lit(0))
    labelled = by_key.join(gold.dim_location.select("location_key", "place"), "location_key", "left")
    return labelled.groupBy("place").agg(final.alias("value"))


def _top(df: DataFrame, ascending: bool, n: int) -> DataFrame:
    value = F.col("value").asc_nulls_last() if ascending else F.col("value").desc_nulls_last()
    return df.orderBy(value, F.col("place").asc_nulls_last()).limit(n)


def highest_temperature(gold: Gold, n: int = 5, **filters) -> DataFrame:
    return _top(by_place(gold, "avg_temperature_celsius", "avg", **filters), False, n)


def lowest_temperature(gold: Gold, n: int = 5, **filters) -> DataFrame:
    return _top(by_place(gold, "avg_temperature_celsius", "avg", **filters), True, n)


def most_humid(gold: Gold, n: int = 5, **filters) -> DataFrame:
    return _top(by_place(gold, "avg_humidity_percent", "avg", **filters), False, n)


def least_humid(gold: Gold, n: int = 5, **filters) -> DataFrame:
    return _top(by_place(gold, "avg_humidity_percent", "avg", **filters), True, n)


def strongest_wind(gold: Gold, n: int = 5, **filters) -> DataFrame:
    return _top(by_place(gold, "max_wind_speed_ms", "max", **filters), False, n)


def weakest_wind(gold: Gold, n: int = 5, **filters) -> DataFrame:
    return _top(by_place(gold, "max_wind_speed_ms", "max", **filters), True, n)


def weather_distribution(gold: Gold, dates: Dates = None, places: Places = None) -> DataFrame:
    """Observations per place and weather text, with their share of the place's total."""
    by_key = (
        fact_rows(gold, dates, places)
        .groupBy("location_key", "weather_key")
        .agg(F.sum("observation_count").alias("_n"))
    )
    counts = (
        by_key.join(gold.dim_location.select("location_key", "place"), "location_key", "left")
        .join(gold.dim_weather.select("weather_key", "weather_description"), "weather_key", "left")
        .groupBy("place", "weather_description")
        .agg(F.sum("_n").alias("observation_count"))
    )
    # One row per place and weather text by now: the window holds no more rows than there are texts.
    in_place = F.sum("observation_count").over(Window.partitionBy("place"))
    return counts.withColumn("share", F.col("observation_count") / F.nullif(in_place, F.lit(0)))


def newest_date_keys(gold: Gold, dates: Dates = None, limit: int = 200) -> DataFrame:
    """One row `keys`: the keys of the newest dates that hold `limit` fact rows together; null if all dates hold fewer.

    Each date counts one row at least, so there are at most `limit` keys. Of a stored fact only row counts are read.
    """
    d = gold.dim_date.select("date_key", "full_date")
    counts = gold.fact_hourly_weather.groupBy("date_key").agg(F.count(F.lit(1)).alias("_n")).join(d, "date_key")
    wanted = _in_dates(F.col("full_date"), dates)
    counts = counts if wanted is None else counts.where(wanted)
    # One row for each date of the calendar.
    newer = Window.orderBy(F.col("full_date").desc(), F.col("date_key").desc())
    found = counts.select(
        "date_key",
        "_n",
        F.coalesce(F.sum("_n").over(newer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    keys = F.sort_array(F.collect_list(F.when(F.col("_before") < limit, F.col("date_key"))))
    return found.agg(F.when(F.sum("_n") >= limit, keys).alias("keys"))


def detail_table(
    gold: Gold, dates: Dates = None, places: Places = None, limit: int = 200, stored: bool = False
) -> DataFrame:
    """The newest fact rows with their labels. Beyond date and hour the order is ours, so that it is total.

    Of a `stored` fact, partitioned by date, the dates' row counts are read first, and then only the newest dates that
    hold enough rows. With `places` these counts say nothing, and all wanted dates are read.
    """
    d = gold.dim_date.select("date_key", "full_date")
    l = gold.dim_location.select("location_key", "place")
    w = gold.dim_weather.select("weather_key", "weather_description")
    fact = gold.fact_hourly_weather
    if stored and places is None:
        keys = newest_date_keys(gold, dates, limit).scalar()
        fact = fact.where(F.coalesce(F.array_contains(keys, F.col("date_key")), keys.isNull()))
    rows = (
        fact.join(l, "location_key", "left")
        .join(d, "date_key", "left")
        .join(w, "weather_key", "left")
    )
    wanted = _in_dates(F.col("full_date"), dates)
    if wanted is not None:
        rows = rows.where(wanted)
    if places is not None:
        rows = rows.where(F.col("place").isin(list(places)))
    newest = rows.orderBy(
        F.col("full_date").desc_nulls_last(),
        F.col("observation_hour").desc_nulls_last(),
        F.col("place").asc_nulls_last(),
        F.col("weather_description").asc_nulls_last(),
        F.col("location_key").asc_nulls_last(),
        F.col("weather_key").asc_nulls_last(),
    ).limit(limit)
    # The titles of the columns.
    return newest.select(
        F.col("full_date").alias("Date"),
        F.col("observation_hour").alias("Hour"),
        F.col("place").alias("Location"),
        F.round("avg_temperature_celsius", 1).alias("Temperature (°C)"),
        F.col("weather_description").alias("Weather Description"),
        F.col("observation_count").alias("Observation Count"),
    )
