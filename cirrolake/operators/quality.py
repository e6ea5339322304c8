"""Data tests on the star schema. Each test is a DataFrame of failing rows; an empty one passes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

RESULT = ["test", "table", "column", "failures"]


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; nulls are not compared."""

    table: str
    column: str
    name = "unique"


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    name = "not_null"


@dataclass(frozen=True)
class Relationship:
    """Every non-null value occurs in the parent's column."""

    table: str
    column: str
    parent: str
    parent_column: str
    name = "relationships"


@dataclass(frozen=True)
class AcceptedRange:
    """Values lie within the bounds, which belong to the range; nulls pass."""

    table: str
    column: str
    low: float | None = None
    high: float | None = None
    name = "accepted_range"


Test = Unique | NotNull | Relationship | AcceptedRange

# The tests of the star schema.
GOLD_TESTS: list[Test] = [
    Unique("dim_location", "location_key"),
    NotNull("dim_location", "location_key"),
    Unique("dim_location", "place"),
    NotNull("dim_location", "place"),
    Unique("dim_date", "date_key"),
    NotNull("dim_date", "date_key"),
    Unique("dim_date", "full_date"),
    NotNull("dim_date", "full_date"),
    Unique("dim_weather", "weather_key"),
    NotNull("dim_weather", "weather_key"),
    NotNull("dim_weather", "weather_code"),
    NotNull("dim_weather", "weather_description"),
    NotNull("fact_hourly_weather", "location_key"),
    Relationship("fact_hourly_weather", "location_key", "dim_location", "location_key"),
    NotNull("fact_hourly_weather", "date_key"),
    Relationship("fact_hourly_weather", "date_key", "dim_date", "date_key"),
    NotNull("fact_hourly_weather", "weather_key"),
    Relationship("fact_hourly_weather", "weather_key", "dim_weather", "weather_key"),
    AcceptedRange("fact_hourly_weather", "observation_hour", 0, 23),
    AcceptedRange("fact_hourly_weather", "avg_temperature_celsius", -80, 80),
    NotNull("fact_hourly_weather", "observation_count"),
    AcceptedRange("fact_hourly_weather", "observation_count", 1),
]


def _row_fails(test: NotNull | AcceptedRange) -> Column:
    value = F.col(test.column)
    if isinstance(test, NotNull):
        return value.isNull()
    outside = F.lit(False)
    if test.low is not None:
        outside = outside | (value < F.lit(test.low))
    if test.high is not None:
        outside = outside | (value > F.lit(test.high))
    return outside


def failing_rows(test: Test, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows a test objects to; for `Unique` the repeated values with their counts."""
    table = tables[test.table]
    match test:
        case Unique():
            present = table.where(F.col(test.column).isNotNull())
            return present.groupBy(test.column).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
        case Relationship():
            parent = tables[test.parent].select(F.col(test.parent_column).alias("_parent"))
            present = table.where(F.col(test.column).isNotNull())
            return present.join(parent, F.col(test.column) == F.col("_parent"), "left_anti")
        case _:
            return table.where(_row_fails(test))


def _labelled(test: Test, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(test.name).alias("test"),
        F.lit(test.table).alias("table"),
        F.lit(test.column).alias("column"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def _row_tests(table: DataFrame, tests: list[Test]) -> DataFrame:
    """All row-wise tests of one table in one pass: a single aggregate, then one output row per test."""
    counts = table.agg(*[F.count_if(_row_fails(t)).alias(f"_{i}") for i, t in enumerate(tests)])
    entries = F.array(
        *[
            F.struct(
                F.lit(t.name).alias("test"),
                F.lit(t.table).alias("table"),
                F.lit(t.column).alias("column"),
                F.col(f"_{i}").cast("bigint").alias("failures"),
            )
            for i, t in enumerate(tests)
        ]
    )
    return counts.select(F.inline(entries))


def _orphan_rows(test: Relationship, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Counted on distinct keys with their row counts, so that the anti join sees each key once."""
    keys = (
        tables[test.table]
        .where(F.col(test.column).isNotNull())
        .groupBy(test.column)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    parent = tables[test.parent].select(F.col(test.parent_column).alias("_parent"))
    orphans = keys.join(parent, F.col(test.column) == F.col("_parent"), "left_anti")
    return _labelled(test, orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures")))


def run_tests(tables: Mapping[str, DataFrame], tests: list[Test] = GOLD_TESTS) -> DataFrame:
    """One row per test with its number of failures."""
    parts: list[DataFrame] = []
    for name in dict.fromkeys(t.table for t in tests):
        row_wise = [t for t in tests if t.table == name and isinstance(t, NotNull | AcceptedRange)]
        if row_wise:
            parts.append(_row_tests(tables[name], row_wise))
    for test in tests:
        if isinstance(test, Unique):
            parts.append(_labelled(test, failing_rows(test, tables).agg(F.count(F.lit(1)).alias("failures"))))
        elif isinstance(test, Relationship):
            parts.append(_orphan_rows(test, tables))
    return reduce(DataFrame.unionByName, parts).select(*RESULT)


class QualityError(Exception):
    """At least one data test failed; the message lists them."""


def gate(tables: Mapping[str, DataFrame], tests: list[Test] = GOLD_TESTS) -> list:
    """Raise unless all tests pass. Brings one row per test to the driver."""
    results = run_tests(tables, tests).collect()
    failed = [r for r in results if r["failures"]]
    if failed:
        raise QualityError("; ".join(f"{r['test']} {r['table']}.{r['column']}: {r['failures']}" for r in failed))
    return results
