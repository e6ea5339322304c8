"""Place lists: distinct cleaned names, selections, coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cirrolake.functions.text import clean_place_name, geocoder_query


def place_names(boundaries: DataFrame, column: str = "tentinh") -> DataFrame:
    """Distinct values of a boundary column, cleaned, as `name`. Two spellings of one place stay two rows."""
    return boundaries.select(F.col(column).alias("name")).distinct().select(clean_place_name(F.col("name")).alias("name"))


def names_within(boundaries: DataFrame, parent: str, parent_column: str = "tentinh", column: str = "tenhc") -> DataFrame:
    """Names in `column` of the rows whose parent area is exactly `parent`."""
    return boundaries.where(F.col(parent_column) == F.lit(parent)).select(column)


def with_queries(names: DataFrame, key: str = "name", *parents: str) -> DataFrame:
    return names.withColumn("query", geocoder_query(F.col(key), *parents))


def attach_coordinates(names: DataFrame, coordinates: DataFrame, key: str = "name") -> DataFrame:
    """Every name with its coordinates, by name; nulls where geocoding failed."""
    return names.join(coordinates.select(key, "latitude", "longitude"), key, "left")


def failed_geocodes(geocoded: DataFrame) -> DataFrame:
    return geocoded.agg(F.count_if(F.col("latitude").isNull()).alias("failed"))
