"""Streams folded into tables, with nothing left out for being late.

What a batch adds is a partial result that can be merged with others in any order: sums with counts, or a minimum. Each
batch writes its own as a delta in a folder named after its number, so a batch that runs again replaces what it wrote.
Closing folds the deltas into the base, one row for each key, and rewrites the dates that they touch; each date keeps the
number of the last batch in it, so no delta counts twice, whenever a run died. A row that comes after its hour was closed
is a delta like any other: readers see it at once, and the next closing folds it in.

There is no watermark and no state in executors: what grows is the table, by one row for each key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from cirrolake.sinks.merge import finish_replacement, folders, path_exists, remove, replace_partitions
from cirrolake.sinks.tables import evenly_by

DATE, UPTO = "fold_date", "fold_upto"


@dataclass(frozen=True)
class Mergeable:
    """A result kept in parts.

    `partial` makes rows into parts, `merge` makes parts of one key into one and leaves the columns as they are; both in
    any grouping give the same in the end. `schema` is that of parts, and the date of `at` says where a part is stored.
    """

    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    schema: StructType
    at: str

    def read(self, spark: SparkSession, path: str, *extra: StructField) -> DataFrame:
        return spark.read.schema(StructType([*self.schema.fields, *extra, StructField(DATE, DateType())])).parquet(path)


def _deltas(root: str) -> str:
    return f"{root.rstrip('/')}/deltas"


def _base(root: str) -> str:
    return f"{root.rstrip('/')}/base"


def _stage(root: str) -> str:
    return f"{root.rstrip('/')}/stage"


def add_batch(state: Mergeable, rows: DataFrame, root: str, number: int) -> None:
    """Write what a batch adds, one part for each of its keys; again under the same number it replaces itself."""
    parts = state.partial(rows).withColumn(DATE, F.to_date(state.at))
    evenly_by(parts, DATE).write.mode("overwrite").partitionBy(DATE).parquet(f"{_deltas(root)}/batch={number}")


def _open(state: Mergeable, spark: SparkSession, root: str) -> tuple[list[int], DataFrame | None, list[dt.date]]:
    """Numbers of the finished deltas, their rows that no closing has folded yet, and these rows' dates.

    Dates are at most one for each day of the calendar.
    """
    numbers = sorted(int(f.removeprefix("batch=")) for f in folders(spark, _deltas(root)) if path_exists(spark, f"{_deltas(root)}/{f}/_SUCCESS"))
    if not numbers:
        return [], None, []
    paths = [f"{_deltas(root)}/batch={n}" for n in numbers]
    schema = StructType([*state.schema.fields, StructField("batch", LongType()), StructField(DATE, DateType())])
    rows = spark.read.schema(schema).option("basePath", _deltas(root)).parquet(*paths)
    if path_exists(spark, _base(root)):
        dates = [r[0] for r in rows.select(DATE).distinct().collect()]
        base = state.read(spark, _base(root), StructField(UPTO, LongType()))
        upto = base.where(F.col(DATE).isin(dates)).groupBy(F.col(DATE).alias("_date")).agg(F.max(UPTO).alias(UPTO))
        rows = rows.join(F.broadcast(upto), F.col(DATE) == F.col("_date"), "left").where(
            F.col(UPTO).isNull() | (F.col("batch") > F.col(UPTO))
        )
    rows = rows.select(*state.schema.names, DATE)
    return numbers, rows, sorted(r[0] for r in rows.select(DATE).distinct().collect())


def current(state: Mergeable, spark: SparkSession, root: str) -> DataFrame:
    """The parts of everything that came so far, one row for each key; dates without open deltas are read as they are."""
    _, rows, dates = _open(state, spark, root)
    if not path_exists(spark, _base(root)):
        return state.merge((rows if rows is not None else spark.createDataFrame([], state.schema)).select(*state.schema.names))
    base = state.read(spark, _base(root))
    if not dates:
        return base.select(*state.schema.names)
    touched = F.col(DATE).isin(dates)
    merged = state.merge(base.where(touched).unionByName(rows).select(*state.schema.names))
    return base.where(~touched).select(*state.schema.names).unionByName(merged)


def close(state: Mergeable, spark: SparkSession, root: str) -> list[dt.date]:
    """Fold the finished deltas into the base and remove them; returns the dates rewritten.

    What a closing before it left half-way is finished first. One closing at a time, between batches.
    """
    full = StructType([*state.schema.fields, StructField(UPTO, LongType()), StructField(DATE, DateType())])
    finish_replacement(spark, full, _base(root), _stage(root), DATE)
    numbers, rows, dates = _open(state, spark, root)
    if dates:
        parts = rows.select(*state.schema.names)
        if path_exists(spark, _base(root)):
            parts = state.read(spark, _base(root)).where(F.col(DATE).isin(dates)).select(*state.schema.names).unionByName(parts)
        merged = state.merge(parts).withColumn(UPTO, F.lit(numbers[-1]).cast("bigint")).withColumn(DATE, F.to_date(state.at))
        replace_partitions(merged.select(*full.names), _base(root), _stage(root), DATE)
    for number in numbers:
        remove(spark, f"{_deltas(root)}/batch={number}")
    return dates


def start_folding(
    stream: DataFrame, state: Mergeable, root: str, checkpoint: str, close_every: int | None = None
) -> StreamingQuery:
    """Fold a stream into the tables below `root`, which belong to this stream alone, until nothing new is available.

    With `close_every` the deltas are folded after so many batches each.
    """

    def write(batch: DataFrame, number: int) -> None:
        add_batch(state, batch, root, number)
        if close_every and (number + 1) % close_every == 0:
            close(state, batch.sparkSession, root)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
