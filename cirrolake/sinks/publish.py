"""Publish a table version only after it is whole and tested.

A version lives in a folder of its own, `run_id=...`. Publishing appends one row to a small log next to the versions;
readers take the newest row. A failed run appends nothing, so readers stay on the version before it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrolake.sinks.merge import folders, remove

LOG = "published"
LOG_SCHEMA = "run_id string, published_at timestamp"


def new_run_id(at: dt.datetime | None = None) -> str:
    at = at or dt.datetime.now(dt.UTC)
    return f"{at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def run_path(root: str, run_id: str, table: str | None = None) -> str:
    path = f"{root.rstrip('/')}/run_id={run_id}"
    return f"{path}/{table}" if table else path


def publish_run(spark: SparkSession, root: str, run_id: str) -> None:
    row = spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("published_at"))
    row.write.mode("append").parquet(f"{root.rstrip('/')}/{LOG}")


def published_run(spark: SparkSession, root: str) -> str:
    """Id of the newest published version; raises when nothing is published."""
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{root.rstrip('/')}/{LOG}")
    newest = log.agg(F.max_by("run_id", F.struct("published_at", "run_id"))).first()
    if newest[0] is None:
        raise LookupError(f"nothing published below {root}")
    return newest[0]


def read_published(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    return spark.read.parquet(run_path(root, published_run(spark, root), table))


def drop_versions(spark: SparkSession, root: str, keep: int, older_than: dt.timedelta | None = None) -> list[str]:
    """Remove published versions but the newest `keep`; with `older_than` only those that were replaced so long ago.

    A reader that holds a version has until then. Versions that were never published, such as one being written, stay.
    """
    there = [f.removeprefix("run_id=") for f in folders(spark, root) if f.startswith("run_id=")]
    if len(there) <= keep:
        return []
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{root.rstrip('/')}/{LOG}").where(F.col("run_id").isin(there))
    last = log.groupBy("run_id").agg(F.max("published_at").alias("published_at"))
    newest = last.orderBy(F.desc("published_at"), F.desc("run_id")).collect()
    dropped = []
    for replaced_by, version in zip(newest[keep - 1 :], newest[keep:]):
        if older_than is None or dt.datetime.now(dt.UTC) - replaced_by["published_at"].astimezone(dt.UTC) >= older_than:
            remove(spark, run_path(root, version["run_id"]))
            dropped.append(version["run_id"])
    return dropped


def repoint_views(spark: SparkSession, root: str, run_id: str, tables: list[str], database: str | None = None) -> None:
    """Point one view per table at a version: catalog views in `database`, else views of the session."""
    for table in tables:
        path = run_path(root, run_id, table)
        if database is None:
            spark.read.parquet(path).createOrReplaceTempView(table)
        else:
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM parquet.`{path}`")
