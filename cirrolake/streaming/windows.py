"""Streaming forms: first rows per hour and hourly aggregates, whole ones folded into tables and quick ones with a watermark.

`first_rows` and `hourly_measures` lose nothing: late rows count whenever they come, see `folding`. `first_arrivals` and
`hourly_weather` give append-only feeds out of state in executors, which a watermark bounds: they leave out late rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cirrolake.functions.calendar import hour_bucket
from cirrolake.functions.measures import mean, total
from cirrolake.operators.silver import deduplicate
from cirrolake.schemas import OBSERVATION_COLUMNS, SILVER
from cirrolake.streaming.folding import Mergeable

# Measure -> the fact's column of its average.
AVERAGES = {
    "temperature": "avg_temperature_celsius",
    "apparent_temperature": "avg_feels_like_celsius",
    "humidity": "avg_humidity_percent",
    "cloud_cover": "avg_cloud_coverage_percent",
}
HOUR_KEYS = ["hour_start", "place", "weather_code", "weather_description"]


def _with_place_and_time(obs: DataFrame) -> DataFrame:
    return obs.where(F.col("place").isNotNull() & F.col("observed_at").isNotNull())


def first_rows() -> Mergeable:
    """Per place and hour the row that Silver keeps, whole: a minimum, so parts are rows of the same kind.

    A batch keeps one row for each key before anything is shuffled, so a hot place is one row for each task.
    """

    def first(rows: DataFrame) -> DataFrame:
        return deduplicate(rows.select(*OBSERVATION_COLUMNS))

    return Mergeable(first, first, T.StructType([SILVER[c] for c in OBSERVATION_COLUMNS]), "observed_at")


def hourly_measures(scale: int | None = None) -> Mergeable:
    """Sums, counts and maxima per place, weather and hour, of which `hourly_result` makes the fact's measures."""
    kind = T.DoubleType() if scale is None else T.DecimalType(38, scale)
    sums = [*AVERAGES, "precipitation"]

    def partial(rows: DataFrame) -> DataFrame:
        value = lambda c: F.col(c) if scale is None else F.col(c).cast(T.DecimalType(18, scale))
        keyed = _with_place_and_time(rows).withColumn("hour_start", hour_bucket(F.col("observed_at")))
        return keyed.groupBy(*HOUR_KEYS).agg(
            *[F.sum(value(c)).cast(kind).alias(f"{c}_sum") for c in sums],
            *[F.count(c).alias(f"{c}_n") for c in AVERAGES],
            F.max("wind_speed").alias("wind_speed_max"),
            F.count("id").alias("observation_count"),
        )

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(*HOUR_KEYS).agg(
            *[F.sum(f"{c}_sum").cast(kind).alias(f"{c}_sum") for c in sums],
            *[F.sum(f"{c}_n").alias(f"{c}_n") for c in AVERAGES],
            F.max("wind_speed_max").alias("wind_speed_max"),
            F.sum("observation_count").alias("observation_count"),
        )

    long = T.LongType()
    fields = [("hour_start", T.TimestampType()), *[(c, SILVER[c].dataType) for c in HOUR_KEYS[1:]]]
    fields += [(f"{c}_sum", kind) for c in sums] + [(f"{c}_n", long) for c in AVERAGES]
    fields += [("wind_speed_max", T.DoubleType()), ("observation_count", long)]
    return Mergeable(partial, merge, T.StructType([T.StructField(*f) for f in fields]), "hour_start")


def hourly_result(parts: DataFrame) -> DataFrame:
    """The fact's measures per place, weather and hour, of merged parts."""
    average = lambda c: F.col(f"{c}_sum").cast("double") / F.nullif(F.col(f"{c}_n"), F.lit(0))
    averages = {name: average(c).alias(name) for c, name in AVERAGES.items()}
    *first, clouds = averages.values()
    return parts.select(
        *HOUR_KEYS,
        *first,
        F.col("wind_speed_max").alias("max_wind_speed_ms"),
        clouds,
        F.col("precipitation_sum").cast("double").alias("total_precipitation_mmh"),
        "observation_count",
    )


def first_arrivals(obs: DataFrame, delay: str = "2 hours") -> DataFrame:
    """The first arrival per place and hour. It need not be the earliest observation; `first_rows` is exact in that.

    `delay` must exceed the longest gap between two arrivals for one hour.
    """
    keyed = _with_place_and_time(obs).withColumn("hour", hour_bucket(F.col("observed_at")))
    return keyed.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(["place", "hour"])


def hourly_weather(obs: DataFrame, delay: str = "2 hours", scale: int | None = None) -> DataFrame:
    """The fact's measures per place, weather and hour, each window given out once the watermark has passed it.

    Rows later than that are left out, and windows that no watermark has passed are never given out.
    """
    return (
        _with_place_and_time(obs)
        .withWatermark("observed_at", delay)
        .groupBy(F.window("observed_at", "1 hour"), "place", "weather_code", "weather_description")
        .agg(
            mean("temperature", scale).alias("avg_temperature_celsius"),
            mean("apparent_temperature", scale).alias("avg_feels_like_celsius"),
            mean("humidity", scale).alias("avg_humidity_percent"),
            F.max("wind_speed").alias("max_wind_speed_ms"),
            mean("cloud_cover", scale).alias("avg_cloud_coverage_percent"),
            total("precipitation", scale).alias("total_precipitation_mmh"),
            F.count("id").alias("observation_count"),
        )
        .select(
            F.col("window.start").alias("hour_start"),
            "place",
            "weather_code",
            "weather_description",
            "avg_temperature_celsius",
            "avg_feels_like_celsius",
            "avg_humidity_percent",
            "max_wind_speed_ms",
            "avg_cloud_coverage_percent",
            "total_precipitation_mmh",
            "observation_count",
        )
    )


def start_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a stream's finished rows to Parquet until nothing new is available."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
