"""Replace whole date partitions of a table that the new rows were computed from."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cirrolake.sinks.tables import evenly_by


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    if not path_exists(spark, path):
        return []
    found = _file_system(spark, path).listStatus(_hadoop_path(spark, path))
    return [f.getPath().getName() for f in found if f.isDirectory()]


Check = Callable[[DataFrame], None]


def replace_partitions(rows: DataFrame, path: str, stage: str, partition: str, check: Check | None = None) -> None:
    """Write `rows` over the partitions of `path` that they fall into; other partitions stay.

    The rows may be read from `path`, so they go to `stage` first, a folder for this one change. A complete stage (with
    its success mark) is taken as it is: a run that died while replacing partitions is finished by calling again with
    the same stage. It is removed at the end. `check` may raise on the staged rows: then nothing is replaced.
    """
    if not path_exists(rows.sparkSession, f"{stage}/_SUCCESS"):
        evenly_by(rows, partition).write.mode("overwrite").partitionBy(partition).parquet(stage)
    finish_replacement(rows.sparkSession, rows.schema, path, stage, partition, check)


def staged(rows: DataFrame, stage: str) -> DataFrame:
    """The rows as written to `stage`, in no arrangement; what a complete stage holds already is taken as it is."""
    if not path_exists(rows.sparkSession, f"{stage}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(stage)
    return rows.sparkSession.read.schema(rows.schema).parquet(stage)


def finish_replacement(
    spark: SparkSession,
    schema: StructType,
    path: str,
    stage: str,
    partition: str | Sequence[str],
    check: Check | None = None,
    arranged: bool = True,
) -> None:
    """Write a complete stage over the partitions of `path`, then remove it. Does nothing when there is none.

    A stage that `check` objects to is removed, and the error raised. An `arranged` stage lies in few files a partition
    already.
    """
    if not path_exists(spark, f"{stage}/_SUCCESS"):
        return
    rows = spark.read.schema(schema).parquet(stage)
    if check is not None:
        try:
            check(rows)
        except Exception:
            remove(spark, stage)
            raise
    columns = [partition] if isinstance(partition, str) else partition
    rows = rows if arranged else evenly_by(rows, *columns)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    remove(spark, stage)
