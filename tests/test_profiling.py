import math
import random

import pandas as pd
import pytest

from builders import values
from cirrolake.operators import profiling


def numbers(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "x double")


def shapes():
    rng = random.Random(3)
    return {
        "few": [3.0, 1.0, 2.0, None, math.nan],
        "one": [5.0],
        "two": [1.0, 4.0],
        "hot value": [7.0] * 700 + [rng.random() for _ in range(300)],
        "steps": [float(rng.randrange(12)) for _ in range(1000)],
        "wide": [rng.lognormvariate(0, 5) * rng.choice([-1, 1]) for _ in range(4000)],
    }


@pytest.mark.parametrize("shape", list(shapes()))
@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_percentiles(spark, shape, accuracy):
    """Exact also when the sketch is coarse."""
    xs = shapes()[shape]
    points = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = profiling.exact_percentiles(numbers(spark, xs).repartition(5), "x", points, accuracy).first()[0]
    expected = pd.Series(xs, dtype="float64").dropna().quantile(list(points)).tolist()
    assert got == expected


@pytest.mark.parametrize("shape", list(shapes()))
def test_ranges_stay_small(spark, shape):
    """Rounds go on until a range holds few rows; hot values are edges, in no range. The result is that of one round."""
    xs, points = shapes()[shape], (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    df = numbers(spark, xs).repartition(3)
    present = [x for x in xs if x is not None and not math.isnan(x)]
    n, found = profiling.selected(df.where("x is not null and not isnan(x)").select(profiling.F.col("x").alias("_v")), points, 20, 8)
    assert n == len(present)
    order = sorted(present)
    for rank, where in found.items():
        if isinstance(where, profiling.Range):
            assert where.size <= 8 and where.before <= rank < where.before + where.size
            assert [x for x in order if (where.low is None or x > where.low) and (where.high is None or x < where.high)] == (
                order[where.before : where.before + where.size]
            )
        else:
            assert where == order[rank]
    got = profiling.exact_percentiles(df, "x", points, 20, 8).first()[0]
    assert got == pd.Series(xs, dtype="float64").dropna().quantile(list(points)).tolist()


def test_percentiles_sort_only_the_last_ranges(spark):
    """The plan ranks what lies in a range around a point; it has no sort of all values."""
    df = spark.range(100_000).select((profiling.F.col("id") * 7919 % 100_003).cast("double").alias("x"))
    values_ = df.select(profiling.F.col("x").alias("_v"))
    n, found = profiling.selected(values_, (0.25, 0.5), 1000, 300)
    assert n == 100_000 and all(x.size <= 300 for x in found.values() if isinstance(x, profiling.Range))
    result = profiling.exact_percentiles(df, "x", (0.25, 0.5), 1000, 300)
    assert result.first()[0] == pd.Series([i * 7919 % 100_003 for i in range(100_000)], dtype="float64").quantile([0.25, 0.5]).tolist()


def test_percentiles_of_infinities(spark):
    xs = [-math.inf, -0.0, 0.0, 1.0, math.inf]
    assert profiling.exact_percentiles(numbers(spark, xs), "x", (0.0, 0.25, 0.5, 0.75, 1.0)).first()[0] == xs


def test_percentiles_of_nothing(spark):
    assert profiling.exact_percentiles(numbers(spark, [None]), "x", (0.5,)).collect()[0][0] == [None]


@pytest.mark.parametrize("scale", [None, 2])
def test_describe(spark, scale):
    xs = [round(random.Random(i).uniform(0, 20), 2) for i in range(500)]
    got = dict(values(profiling.describe(numbers(spark, [*xs, None]), "x", scale)))
    expected = pd.Series(xs).describe().to_dict()
    assert set(got) == set(expected)
    for k in expected:
        assert got[k] == pytest.approx(expected[k], rel=1e-12), k


def test_describe_one(spark):
    got = dict(values(profiling.describe(numbers(spark, [2.0]), "x", 1)))
    assert (got["count"], got["std"], got["50%"]) == (1.0, None, 2.0)


def test_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b")], "n int, t string")
    assert values(profiling.distinct_counts(df)) == [("n", 2), ("t", 2)]
    assert values(profiling.distinct_counts(df, ["t"], rsd=0.05)) == [("t", 2)]
    assert values(profiling.column_info(df)) == [("n", 3, "int"), ("t", 3, "string")]
    assert [r.n for r in profiling.preview(df, "n", "t", n=2).collect()] == [None, 1]
