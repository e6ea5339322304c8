"""Labels for right-closed value ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Bin edges and labels of the derived categories.
WIND_EDGES = (-0.1, 0.2, 1.5, 3.3, 5.5, 7.9, 10.7, 13.8)
WIND_LABELS = (
    "Calm",
    "Light air",
    "Light breeze",
    "Gentle breeze",
    "Moderate breeze",
    "Fresh breeze",
    "Strong breeze",
)
UV_EDGES = (-0.1, 2, 5, 7, 10, 15)
UV_LABELS = ("Low", "Moderate", "High", "Very High", "Extreme")


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the range (low, high] that holds the value; null when none does. NaN is above every edge."""
    lowest, *uppers = (float(e) for e in edges)
    label = F.when(~(value > F.lit(lowest)), F.lit(None).cast("string"))
    for high, name in zip(uppers, labels, strict=True):
        label = label.when(value <= F.lit(high), F.lit(name))
    return label


def wind_category(speed: Column) -> Column:
    return cut(speed, WIND_EDGES, WIND_LABELS)


def uv_category(index: Column) -> Column:
    return cut(index, UV_EDGES, UV_LABELS)
