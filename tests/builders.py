"""Hand-made rows for the tests."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrolake.operators.silver import conform, to_silver
from cirrolake.schemas import BRONZE, OBSERVATION_COLUMNS, SILVER

UTC = dt.UTC
NOON = dt.datetime(2025, 10, 30, 12, tzinfo=UTC)


def at(hour: int, minute: int = 0, second: int = 0, micro: int = 0, day: int = 30) -> dt.datetime:
    return dt.datetime(2025, 10, day, hour, minute, second, micro, tzinfo=UTC)


def observations(spark: SparkSession, *rows: dict) -> DataFrame:
    """Observation rows; columns that a row does not name are null."""
    schema = ", ".join(f"{n} {SILVER[n].dataType.simpleString()}" for n in OBSERVATION_COLUMNS)
    return conform(spark.createDataFrame([tuple(r.get(n) for n in OBSERVATION_COLUMNS) for r in rows], schema))


def obs(place="A", observed_at=NOON, **more) -> dict:
    return {"id": "1", "place": place, "observed_at": observed_at, "ingested_at": NOON} | more


def silver(spark: SparkSession, *rows: dict) -> DataFrame:
    return to_silver(observations(spark, *rows))


def bronze(spark: SparkSession, *payloads, source="weatherbit_current") -> DataFrame:
    """Bronze rows around payloads, each a dict or a text as it is."""
    rows = [
        (str(i), source, p if isinstance(p, str | None) else json.dumps(p, ensure_ascii=False), None, None, NOON, NOON.date())
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, BRONZE)


def responses(spark: SparkSession, *bodies) -> DataFrame:
    """Landed documents, each a dict or a text as it is."""
    text = [(b if isinstance(b, str) else json.dumps(b, ensure_ascii=False),) for b in bodies]
    docs = spark.createDataFrame(text, "body string")
    return docs.select(F.get_json_object("body", "$.place_name").alias("place_name"), "body")


def values(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as tuples in a fixed order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
