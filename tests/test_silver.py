import math
import random

from pyspark.sql import functions as F

from builders import NOON, at, bronze, obs, observations, silver, values
from cirrolake.operators.silver import bronze_to_silver, deduplicate, to_silver
from cirrolake.schemas import SILVER


def kept(spark, *rows):
    return [r[0] for r in values(deduplicate(observations(spark, *rows)), "id")]


def test_schema(spark):
    got = bronze_to_silver(bronze(spark, {"place_name": "A", "ts": 1761800400}))
    assert got.columns == SILVER.names and [f.dataType for f in got.schema] == [f.dataType for f in SILVER]
    # A measure that no payload has is a column of null doubles.
    assert values(got, "aqi", "observation_hour", "day_of_week", "month") == [(None, 5, "Thursday", 10)]


def test_earliest_of_an_hour(spark):
    assert kept(spark, obs(id="late", observed_at=at(3, 40)), obs(id="early", observed_at=at(3, 5))) == ["early"]


def test_ties(spark):
    same = at(3, 5)
    assert kept(
        spark,
        obs(id="a", observed_at=same, ingested_at=at(4)),
        obs(id="c", observed_at=same, ingested_at=at(5)),
        obs(id="b", observed_at=same, ingested_at=at(5)),
        obs(id="0", observed_at=same, ingested_at=None),
    ) == ["b"]


def test_hour_border(spark):
    rows = [obs(id="1", observed_at=at(3, 59, 59, 999_999)), obs(id="2", observed_at=at(4))]
    assert kept(spark, *rows) == ["1", "2"]


def test_rows_without_key(spark):
    assert kept(spark, obs(id="1", place=None), obs(id="2", observed_at=None), obs(id="3")) == ["3"]


def test_places_and_null_ids(spark):
    rows = [obs(place="A", id=None), obs(place="B", id=None)]
    assert kept(spark, *rows) == [None, None]


def test_nan_is_missing(spark):
    row = silver(spark, obs(wind_speed=math.nan, uv_index=math.nan, temperature=math.nan)).first()
    assert (row.wind_speed, row.wind_category, row.uv_category, row.temperature) == (None, None, None, None)


def random_rows(n=400):
    rng = random.Random(7)
    return [
        obs(
            place=rng.choice("AAAABC"),
            observed_at=at(rng.randrange(4), rng.randrange(3), 0),
            ingested_at=at(12, rng.randrange(2)),
            id=str(rng.randrange(20)),
            temperature=float(rng.randrange(5)),
        )
        for _ in range(n)
    ]


def test_order_of_rows_does_not_matter(spark):
    rows = random_rows()
    expected = values(silver(spark, *rows))
    random.Random(8).shuffle(rows)
    shuffled = to_silver(observations(spark, *rows).repartition(7))
    assert values(shuffled) == expected
    assert len({(r.place, r.observed_at.replace(minute=0)) for r in shuffled.collect()}) == len(expected)


def test_idempotent(spark):
    once = silver(spark, *random_rows())
    assert values(to_silver(once)) == values(once)


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all rows in one hour of one place leaves each task as one row."""
    hot = spark.range(0, 30_000, numPartitions=4).select(
        F.col("id").cast("string").alias("id"),
        F.lit("hot").alias("place"),
        F.timestamp_seconds(F.lit(int(NOON.timestamp())) + F.col("id") % 3600).alias("observed_at"),
    )
    result = to_silver(hot)
    assert [r.id for r in result.collect()] == ["0"]
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
