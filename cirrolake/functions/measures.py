"""Aggregates over measures, plain or exact for values of a fixed scale."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType


def total(column: str | Column, scale: int | None = None) -> Column:
    """Sum; null when every value is null.

    Sums of doubles depend on the order in which partial sums meet, which differs from run to run. With `scale` the
    values are summed as decimals with that many fraction digits, so every run gives the same bits.
    """
    c = F.col(column) if isinstance(column, str) else column
    if scale is None:
        return F.sum(c)
    return F.sum(c.cast(DecimalType(18, scale))).cast("double")


def mean(column: str | Column, scale: int | None = None) -> Column:
    """Average of the non-null values; see `total` for `scale`."""
    c = F.col(column) if isinstance(column, str) else column
    if scale is None:
        return F.avg(c)
    return total(c, scale) / F.nullif(F.count(c), F.lit(0))
