"""Observations to Bronze: raw payload in a fixed envelope."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from cirrolake.functions import jsonmap
from cirrolake.functions.keys import with_observation_id

# The label in the table and the label inside the id, per feed.
CURRENT_SOURCE, CURRENT_ID_SOURCE = "weatherbit_current", "weatherbit"
HISTORY_SOURCE, HISTORY_ID_SOURCE = "weatherbit_historical", "weatherbit_historical"


def envelope(
    observations: DataFrame, source: str, id_source: str, ingested_at: dt.datetime, obs: str = "obs"
) -> DataFrame:
    """Bronze rows from maps of JSON values, or from payloads with the values of an id. One ingest time per batch.

    Of a map the payload keeps every key, nulls too, and numbers in their shortest form; a payload stays as it is.
    Classified rows keep their `reason`. Rejected ones have what was rejected as payload, no id, and no ingest date, by
    which Bronze stores them apart.
    """
    batch = F.lit(ingested_at)
    if "payload" in observations.columns:
        payload, ts = F.col("payload"), F.col("ts")
        lat, lon = (F.col(c).try_cast("double") for c in ("lat", "lon"))
    else:
        m = F.col(obs)
        payload, ts = F.to_json(m, {"ignoreNullFields": "false"}), jsonmap.text(m, "ts")
        lat, lon = (jsonmap.number(m, c) for c in ("lat", "lon"))
    tagged = "reason" in observations.columns
    parts = observations.select(
        (F.coalesce("rejected", payload) if tagged else payload).alias("raw_payload"),
        lat.alias("lat"),
        lon.alias("lon"),
        ts.alias("ts"),
        *(["reason"] if tagged else []),
    )
    named = with_observation_id(parts, id_source)
    accepted = F.col("reason").isNull() if tagged else F.lit(True)
    return named.select(
        F.when(accepted, F.col("observation_id")).alias("observation_id"),
        F.lit(source).alias("source"),
        "raw_payload",
        "lat",
        "lon",
        batch.cast("timestamp").alias("_ingested_at"),
        F.when(accepted, F.to_date(batch.cast("timestamp"))).alias("ingest_date"),
        *(["reason"] if tagged else []),
    )


def current_to_bronze(observations: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    return envelope(observations, CURRENT_SOURCE, CURRENT_ID_SOURCE, ingested_at)


def history_to_bronze(observations: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    return envelope(observations, HISTORY_SOURCE, HISTORY_ID_SOURCE, ingested_at)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All feeds by column name; a column that one feed lacks is null there."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed, allowMissingColumns=True)
    return first
