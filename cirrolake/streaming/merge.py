"""Incremental Silver and fact: only the dates that new rows fall on are computed anew."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cirrolake.operators.fact import fact_from_same_silver
from cirrolake.operators.silver import add_features, deduplicate
from cirrolake.schemas import OBSERVATION_COLUMNS
from cirrolake.sinks.merge import Check, path_exists, remove, replace_partitions
from cirrolake.sinks.tables import evenly_by
from cirrolake.sources.tables import FACT_PARTITION, SILVER_PARTITION, read_gold_table, read_silver


def touched_dates(arrivals: DataFrame) -> list[dt.date]:
    """The calendar dates of observations that lie in a folder for each date, at most one per day of the calendar."""
    return sorted(r[SILVER_PARTITION] for r in arrivals.select(SILVER_PARTITION).distinct().collect())


def merge_silver(new: DataFrame, silver_path: str, stage: str, check: Check | None = None) -> list[dt.date]:
    """Fold observations into a date-partitioned Silver table; returns the dates written.

    The surviving row of a place and hour is a minimum in a total order. A minimum may be taken of the old minimum and
    the new rows, so merging batch by batch ends where one pass over everything would. New rows are computed once, into
    a folder for each date beside the stage. `check` may object to the staged partitions; then none is replaced.
    """
    spark = new.sparkSession
    new = new.select(*OBSERVATION_COLUMNS).where(F.col("observed_at").isNotNull() & F.col("place").isNotNull())
    arrived = f"{stage}-arrivals"
    dated = new.withColumn(SILVER_PARTITION, F.to_date("observed_at"))
    evenly_by(dated, SILVER_PARTITION).write.mode("overwrite").partitionBy(SILVER_PARTITION).parquet(arrived)
    arrivals = spark.read.schema(dated.schema).parquet(arrived)
    dates = touched_dates(arrivals)
    if not dates:
        remove(spark, arrived)
        return dates
    rows = new = arrivals.select(*OBSERVATION_COLUMNS)
    if path_exists(spark, silver_path):
        rows = read_silver(spark, silver_path, dates).select(*OBSERVATION_COLUMNS).unionByName(new)
    merged = add_features(deduplicate(rows)).withColumn(SILVER_PARTITION, F.to_date("observed_at"))
    replace_partitions(merged, silver_path, stage, SILVER_PARTITION, check)
    remove(spark, arrived)
    return dates


def refresh_fact(spark: SparkSession, silver_path: str, fact_path: str, stage: str, dates: list[dt.date]) -> None:
    """Recompute the fact's partitions of the given dates from Silver."""
    if dates:
        replace_partitions(
            fact_from_same_silver(read_silver(spark, silver_path, dates)), fact_path, stage, FACT_PARTITION
        )


def read_fact(spark: SparkSession, fact_path: str) -> DataFrame:
    return read_gold_table(spark, fact_path, "fact_hourly_weather")


def merging_sink(silver_path: str, stages: str, check: Check | None = None) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function. A batch that is run again after a failure finds its own finished stage and reuses it.

    Batch numbers belong to one stream, so `stages` must too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_silver(batch, silver_path, f"{stages}/batch={batch_id}", check)

    return write


def start_merge(stream: DataFrame, silver_path: str, checkpoint: str, check: Check | None = None) -> StreamingQuery:
    """Fold a stream of observations into Silver until nothing new is available.

    `check` sees the staged dates of each batch and may raise: then the stream ends and Silver stays as it was. A whole
    star schema with stored dimensions and its tests is kept by `live.start_live`.
    """
    return (
        stream.writeStream.foreachBatch(merging_sink(silver_path, f"{checkpoint.rstrip('/')}/stages", check))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
