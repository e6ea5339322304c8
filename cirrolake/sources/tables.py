"""Reads of the lakehouse's own tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from cirrolake.schemas import BRONZE, DATE, GOLD, REJECT_COLUMNS, SILVER, STRING

SILVER_PARTITION = "observed_date"
FACT_PARTITION = "date_key"


def read_bronze(spark: SparkSession, path: str, since: dt.date | None = None, merge: bool = False) -> DataFrame:
    """The raw table; `since` prunes older ingest dates.

    Its seven columns are declared, so no file needs to be opened to learn them. With `merge` all files are asked, and
    envelope columns that only some of them have are kept.
    """
    if merge:
        bronze = spark.read.option("mergeSchema", True).parquet(path).drop("batch", "reason")
    else:
        bronze = spark.read.schema(BRONZE).parquet(path).select(*BRONZE.names)
    # Rejected rows have no ingest date.
    return bronze.where(F.col("ingest_date").isNotNull() if since is None else F.col("ingest_date") >= F.lit(since))


def read_rejected_bronze(spark: SparkSession, path: str) -> DataFrame:
    """(source, reason, payload, ingested_at) of what was landed and is no observation."""
    schema = StructType([*BRONZE.fields, StructField("reason", STRING)])
    rows = spark.read.schema(schema).parquet(path).where(F.col("ingest_date").isNull())
    return rows.select("source", "reason", F.col("raw_payload").alias("payload"), F.col("_ingested_at").alias("ingested_at"))


def read_silver(
    spark: SparkSession, path: str, dates: Sequence[dt.date] | None = None, keep_date: bool = False
) -> DataFrame:
    """Silver's 29 columns; `dates` prunes the scan to those observed dates.

    With `keep_date` the partition column follows them, for questions that prune by it.
    """
    schema = StructType([*SILVER.fields, StructField(SILVER_PARTITION, DATE)])
    # Rejected rows lie in a partition without a date.
    silver = spark.read.schema(schema).parquet(path).where(F.col(SILVER_PARTITION).isNotNull())
    if dates is not None:
        silver = silver.where(F.col(SILVER_PARTITION).isin(list(dates)))
    return silver if keep_date else silver.select(*SILVER.names)


def read_rejected_silver(spark: SparkSession, path: str) -> DataFrame:
    """(source, reason, payload, ingested_at) of Bronze rows that gave no observation."""
    extra = [StructField(c, STRING) for c in REJECT_COLUMNS]
    schema = StructType([*SILVER.fields, *extra, StructField(SILVER_PARTITION, DATE)])
    rows = spark.read.schema(schema).parquet(path).where(F.col(SILVER_PARTITION).isNull())
    return rows.select("source", "reason", F.col("raw_payload").alias("payload"), "ingested_at")


def read_gold_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of the star schema, its columns in their order wherever the partition column is stored."""
    return spark.read.schema(GOLD[table]).parquet(path).select(*GOLD[table].names)


def stage_silver(silver: DataFrame, view: str = "stg_weather_observations") -> DataFrame:
    """Name Silver for SQL users; the view stores nothing."""
    silver.createOrReplaceTempView(view)
    return silver.sparkSession.table(view)
