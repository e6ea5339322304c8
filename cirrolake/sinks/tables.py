"""Writes of Bronze, Silver and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, functions as F

from cirrolake.schemas import REJECT_COLUMNS, SILVER
from cirrolake.sources.tables import FACT_PARTITION, SILVER_PARTITION


def counted(df: DataFrame, seen: Observation) -> DataFrame:
    """Count rows while they are written, without a second job; those with a `reason` are counted apart.

    It must be the last step before a write. In a task that feeds a shuffle, rows would count again when the task is
    run again after an executor was lost.
    """
    accepted = F.col("reason").isNull() if "reason" in df.columns else F.lit(True)
    return df.observe(seen, F.count_if(accepted).alias("rows"), F.count_if(~accepted).alias("rejected"))


def rows_of(seen: Observation, which: str = "rows") -> int:
    return seen.get.get(which, 0)


def append_bronze(bronze: DataFrame, path: str, batch: str | None = None) -> int:
    """Append one batch, partitioned by ingest date; returns its number of accepted rows, taken while writing.

    Rejected rows, which have a `reason` and no ingest date, go to a partition of their own in the same job.

    Each batch has a folder of its own, so several feeds, streams and batch runs can append to one table. A batch that
    is written again under its name replaces itself; without a name it is a new one. An empty batch writes nothing. The
    plan has no shuffle, so looking for a first row reads little.
    """
    if bronze.isEmpty():
        return 0
    seen = Observation()
    counted(bronze, seen).write.mode("overwrite").partitionBy("ingest_date").parquet(f"{path}/batch={batch or uuid.uuid4().hex}")
    return rows_of(seen)


def evenly_by(df: DataFrame, *partition: str) -> DataFrame:
    """Rows arranged so that each value of the partition columns lands in few files of even size.

    The rebalance lets AQE merge small values and split large ones, so neither one task writes a hot value nor does
    every task write a file for every value.
    """
    return df.hint("rebalance", *partition)


def write_silver(silver: DataFrame, path: str) -> int:
    """Write Silver into a folder of its own and return its row count."""
    return write_silver_and_rejects(silver, path)[0]


def write_silver_and_rejects(silver: DataFrame, path: str) -> tuple[int, int]:
    """Write Silver, and rejected rows if it has REJECT_COLUMNS, in one job; returns the number of both.

    Rejected rows have no date in the partition column: they lie apart, and reads of Silver prune them.
    """
    tagged = silver.columns[len(SILVER) :] == REJECT_COLUMNS
    own = silver.schema.fields[: len(SILVER)] if tagged else silver.schema.fields
    if [f.name for f in own] != SILVER.names or [f.dataType for f in own] != [f.dataType for f in SILVER]:
        raise TypeError(f"not the Silver schema: {silver.schema.simpleString()}")
    seen = Observation()
    date = F.to_date("observed_at")
    rows = silver.withColumn(SILVER_PARTITION, F.when(F.col("reason").isNull(), date) if tagged else date)
    counted(evenly_by(rows, SILVER_PARTITION), seen).write.mode("errorifexists").partitionBy(SILVER_PARTITION).parquet(path)
    return rows_of(seen), rows_of(seen, "rejected")


def write_fact(fact: DataFrame, path: str) -> None:
    """Write the fact partitioned by date, so that a filter on dates reads those dates only."""
    evenly_by(fact, FACT_PARTITION).write.mode("errorifexists").partitionBy(FACT_PARTITION).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
