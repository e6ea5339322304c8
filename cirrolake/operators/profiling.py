"""Profiles of a table: counts, distinct values, summary of a number."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import add, and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from cirrolake.functions.measures import total

#: Rows of a range of values that one task may sort.
LARGEST_RANGE = 1_000_000


def _long(row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """A single row of one number per column as rows (column, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in columns])
    return row.select(F.inline(pairs))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, rsd: float | None = None) -> DataFrame:
    """Number of distinct non-null values per column; with `rsd` estimated with that relative error in one pass.

    Exactly, each column is a scan of its own: several distinct counts in one aggregate would write every row once per
    column, each time with all columns.
    """
    columns = list(columns or df.columns)
    if rsd is not None:
        return _long(df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(c) for c in columns]), columns, "n_unique")
    counts = [
        df.select(F.col(c).alias("_v")).distinct().agg(F.lit(c).alias("column"), F.count("_v").alias("n_unique"))
        for c in columns
    ]
    return reduce(DataFrame.unionByName, counts)


def column_info(df: DataFrame) -> DataFrame:
    """Number of non-null values and type per column."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"), F.col(f"`{name}`").alias("non_null"), F.lit(kind).alias("type")
            )
            for name, kind in df.dtypes
        ]
    )
    return counts.select(F.inline(rows))


class Range(NamedTuple):
    """The values between two others, both left out; None is no bound. `before` rows lie below it, `size` rows in it."""

    low: float | None
    high: float | None
    before: int
    size: int

    def holds(self, v: Column) -> Column:
        bounds = [v > self.low] if self.low is not None else []
        bounds += [v < self.high] if self.high is not None else []
        return reduce(and_, bounds, F.lit(True))


def _cut(values: DataFrame, cuts: dict[Range, list[float]], accuracy: int) -> Iterator[Range | tuple[float, int, int]]:
    """One round: sketched edges close around some fractions of each range, then the row counts between them.

    Gives the smaller ranges and, as (value, before, size), the edges themselves: rows of an edge's value are counted
    apart, so a hot value is found by counting and no range keeps it.
    """
    margin, v = 2.0 / accuracy, F.col("_v")
    sketches = []
    for part, fractions in cuts.items():
        near = sorted({min(max(f + d, 0.0), 1.0) for f in fractions for d in (-margin, margin)})
        sketches.append(F.percentile_approx(F.when(part.holds(v), v), near, F.lit(accuracy)))
    edges = [sorted(set(found or ())) for found in values.agg(*sketches).first()]
    place = F.lit(None)
    for i, (part, at) in enumerate(zip(cuts, edges)):
        below = reduce(add, [F.when(v > e, 2).when(v == e, 1).otherwise(0) for e in at], F.lit(0))
        place = F.when(part.holds(v), F.struct(F.lit(i).alias("part"), below.alias("step"))).otherwise(place)
    counted = values.select(place.alias("at")).where("at is not null").groupBy("at.part", "at.step").count()
    sizes = {(r["part"], r["step"]): r["count"] for r in counted.collect()}
    for i, (part, at) in enumerate(zip(cuts, edges)):
        before, bounds = part.before, [part.low, *at, part.high]
        for step in range(2 * len(at) + 1):
            size = sizes.get((i, step), 0)
            if step % 2:
                yield at[step // 2], before, size
            elif size:
                yield Range(bounds[step // 2], bounds[step // 2 + 1], before, size)
            before += size


def selected(
    values: DataFrame, points: Sequence[float], accuracy: int, largest: int
) -> tuple[int, dict[int, float | Range]]:
    """(number of rows, for each rank that the points need its value, or the range of at most `largest` rows with it).

    A round divides a range by about accuracy / 4, and only ranges above `largest` rows see another one.
    """
    whole = Range(None, None, 0, 0)
    pieces = list(_cut(values, {whole: list(points)}, accuracy))
    n = sum(p.size if isinstance(p, Range) else p[2] for p in pieces)
    positions = [p * (n - 1) for p in points] if n else []
    found: dict[int, float | Range] = {}
    wanted = sorted({r for p in positions for r in (math.floor(p), math.ceil(p))})
    while True:
        for rank in wanted:
            for piece in pieces:
                value, before, size = (piece, piece.before, piece.size) if isinstance(piece, Range) else piece
                if before <= rank < before + size:
                    found[rank] = value
        wide: dict[Range, list[float]] = {}
        wanted = [r for r in wanted if isinstance(found[r], Range) and found[r].size > largest]
        for rank in wanted:
            wide.setdefault(found[rank], []).append((rank - found[rank].before) / (found[rank].size - 1))
        if not wide:
            return n, found
        pieces = list(_cut(values, wide, accuracy))


def exact_percentiles(
    df: DataFrame, column: str, points: Sequence[float], accuracy: int = 10_000, largest: int = LARGEST_RANGE
) -> DataFrame:
    """Percentiles with linear interpolation as one row `percentiles`, an array in the order of `points`.

    The built-in exact `percentile` keeps every distinct value in one buffer. Here a sketch gives two edges close
    around each point, and the row counts between the edges tell which range holds a wanted position; ranges of more
    than `largest` rows are cut again. Only the values of the ranges that remain are shuffled and ranked, so no task
    sorts more than `largest` of them. The sketch decides how many rounds it takes, never the result. The rounds run when
    the function is called and bring a few edges and counts to the driver; `df` must give the same rows each time.
    """
    v = F.col(column).cast("double")
    values = df.where(v.isNotNull() & ~F.isnan(v)).select((v + F.lit(0.0)).alias("_v"))
    n, found = selected(values, points, accuracy, largest)
    if not n:
        return df.sparkSession.range(1).select(F.array(*[F.lit(None).cast("double") for _ in points]).alias("percentiles"))

    ranges = list(dict.fromkeys(x for x in found.values() if isinstance(x, Range)))
    number = reduce(lambda other, i: F.when(ranges[i].holds(F.col("_v")), i).otherwise(other), range(len(ranges)), F.lit(None))
    inside = values.select("_v", number.cast("int").alias("_range")).where("_range is not null")
    counts = inside.groupBy("_range", "_v").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_first", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    hits, at = [], {}
    for rank, where in found.items():
        if isinstance(where, Range):
            near = F.lit(rank - where.before)
            holds = (F.col("_range") == ranges.index(where)) & (F.col("_first") <= near) & (near < F.col("_first") + F.col("_n"))
            at[rank] = F.col(f"_hit{len(hits)}")
            hits.append(F.max(F.when(holds, F.col("_v"))).alias(f"_hit{len(hits)}"))
        else:
            at[rank] = F.lit(where)
    picked = ranked.agg(*hits) if hits else df.sparkSession.range(1)
    result = []
    for p in points:
        position = p * (n - 1)
        low, high, t = at[math.floor(position)], at[math.ceil(position)], position - math.floor(position)
        if t == 0:
            result.append(low)
        else:
            result.append(low + (high - low) * t if t < 0.5 else high - (high - low) * (1 - t))
    return picked.select(F.array(*result).alias("percentiles"))


def describe(df: DataFrame, column: str, scale: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of a numeric column as rows (statistic, value).

    With `scale` the mean and the deviation come from exact decimal sums.
    """
    v = F.col(column).cast("double")
    present = df.where(v.isNotNull() & ~F.isnan(v)).select(v.alias("_v"))
    if scale is None:
        average, deviation = F.avg("_v"), F.stddev_samp("_v")
    else:
        n = F.count("_v").cast("double")
        exact = F.col("_v").cast(f"decimal(18,{scale})")
        squares = F.sum((exact * exact).cast(f"decimal(36,{2 * scale})")).cast("double")
        sums = total("_v", scale)
        average = sums / F.nullif(n, F.lit(0.0))
        deviation = F.when(n > 1, F.sqrt((squares - sums * sums / n) / F.when(n > 1, n - 1)))
    base = present.agg(
        F.count("_v").alias("n"),
        average.alias("mean"),
        deviation.alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    q = exact_percentiles(present, "_v", (0.25, 0.5, 0.75)).scalar()
    named = base.withColumn("q", q)
    rows = [
        ("count", F.col("n").cast("double")),
        ("mean", F.col("mean")),
        ("std", F.col("std")),
        ("min", F.col("min")),
        ("25%", F.col("q")[0]),
        ("50%", F.col("q")[1]),
        ("75%", F.col("q")[2]),
        ("max", F.col("max")),
    ]
    entries = F.array(*[F.struct(F.lit(k).alias("statistic"), c.alias("value")) for k, c in rows])
    return named.select(F.inline(entries))


def preview(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """The first rows; with `order` the same ones every time."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)
