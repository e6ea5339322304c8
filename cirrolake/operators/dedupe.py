"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    In the `row_number() = 1` form Spark keeps one row per key and task before the shuffle already, so copies of a hot
    key do not travel.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def total_order(df: DataFrame, *leading: Column) -> list[Column]:
    """The leading keys, then a hash of the whole row, so that ties do not depend on how rows are spread over tasks."""
    return [*leading, F.xxhash64(*df.columns).asc()]
