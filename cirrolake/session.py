"""Session settings the engine relies on, and the folder for intermediate tables."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# All times are UTC instants; hours, dates and day names are taken from them.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Of a JSON object's repeated key the last value counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "cirrolake", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores).replace("*", "8"))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for tables of one run, below the shared folder that the cluster names in `spark.checkpoint.dir`.

    Where that is unset the folder lies in the warehouse, which all executors share as well. It is removed when the
    session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/cirrolake/{label}-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    return folder


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Make a folder and have the file system remove it when the session's JVM ends; until then it may still be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)


def importable_by_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver does, whatever their working folder.

    It serves executors that see the driver's folder; others get the package with `--py-files`.
    """
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def s3_settings(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Settings to read and write an S3-compatible store with path-style addresses; TLS follows the endpoint's scheme."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https://")).lower(),
    }
