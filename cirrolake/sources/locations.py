"""Location lists in CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cirrolake.schemas import DOUBLE, STRING


def read_locations(spark: SparkSession, path: str, key: str = "name") -> DataFrame:
    """Geocoded places: `key`, latitude, longitude. A missing file raises."""
    schema = T.StructType(
        [T.StructField(key, STRING), T.StructField("latitude", DOUBLE), T.StructField("longitude", DOUBLE)]
    )
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False)


def read_names(spark: SparkSession, path: str, key: str = "name") -> DataFrame:
    """A one-column list of place names."""
    return spark.read.csv(path, schema=T.StructType([T.StructField(key, STRING)]), header=True, enforceSchema=False)


def read_boundaries(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An administrative boundary table; `columns` names all its columns in file order, each read as text."""
    schema = T.StructType([T.StructField(c, STRING) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, multiLine=False)
