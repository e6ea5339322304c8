import pytest

from builders import values
from cirrolake.operators import quality as q
from cirrolake.schemas import GOLD


def frame(spark, table, *rows):
    names = GOLD[table].names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], GOLD[table])


def fact_row(**more):
    row = {"location_key": "l", "date_key": 20251030, "weather_key": "w", "observation_hour": 5,
           "avg_temperature_celsius": 20.0, "observation_count": 1}
    return row | more


def gold(spark, fact, locations=({"location_key": "l", "place": "A"},), weather=None):
    import datetime as dt

    return {
        "dim_location": frame(spark, "dim_location", *locations),
        "dim_date": frame(spark, "dim_date", {"date_key": 20251030, "full_date": dt.date(2025, 10, 30)}),
        "dim_weather": frame(
            spark, "dim_weather", *(weather or [{"weather_key": "w", "weather_code": 1.0, "weather_description": "x"}])
        ),
        "fact_hourly_weather": frame(spark, "fact_hourly_weather", *fact),
    }


def failures(tables):
    return {(r.test, r.table, r.column): r.failures for r in q.run_tests(tables).collect() if r.failures}


def test_the_tests():
    kinds = [t.name for t in q.GOLD_TESTS]
    assert {k: kinds.count(k) for k in kinds} == {"unique": 5, "not_null": 11, "relationships": 3, "accepted_range": 3}


def test_clean(spark):
    tables = gold(spark, [fact_row(), fact_row(observation_hour=23, avg_temperature_celsius=-80.0)])
    assert failures(tables) == {}
    assert len(q.gate(tables)) == 22


@pytest.mark.parametrize(
    "row, test, column",
    [
        ({"location_key": "?"}, "relationships", "location_key"),
        ({"date_key": 1}, "relationships", "date_key"),
        ({"weather_key": "?"}, "relationships", "weather_key"),
        ({"weather_key": None}, "not_null", "weather_key"),
        ({"observation_hour": 24}, "accepted_range", "observation_hour"),
        ({"observation_hour": -1}, "accepted_range", "observation_hour"),
        ({"avg_temperature_celsius": 81.0}, "accepted_range", "avg_temperature_celsius"),
        ({"observation_count": 0}, "accepted_range", "observation_count"),
        ({"observation_count": None}, "not_null", "observation_count"),
    ],
)
def test_one_defect(spark, row, test, column):
    tables = gold(spark, [fact_row(), fact_row(**row)])
    assert failures(tables) == {(test, "fact_hourly_weather", column): 1}
    one = next(t for t in q.GOLD_TESTS if (t.name, t.table, t.column) == (test, "fact_hourly_weather", column))
    assert q.failing_rows(one, tables).count() == 1
    with pytest.raises(q.QualityError, match=f"{test} fact_hourly_weather.{column}: 1"):
        q.gate(tables)


def test_nulls_pass_ranges_and_references(spark):
    tables = gold(spark, [fact_row(avg_temperature_celsius=None, observation_hour=None)])
    assert failures(tables) == {}


def test_orphans_are_counted_by_row(spark):
    assert failures(gold(spark, [fact_row(location_key="?")] * 3)) == {
        ("relationships", "fact_hourly_weather", "location_key"): 3
    }


def test_duplicates(spark):
    places = [{"location_key": "l", "place": p} for p in ("A", "B", None, None)]
    tables = gold(spark, [fact_row()], places)
    assert failures(tables) == {("unique", "dim_location", "location_key"): 1, ("not_null", "dim_location", "place"): 2}
    assert values(q.failing_rows(q.Unique("dim_location", "location_key"), tables)) == [("l", 4)]
    assert values(q.failing_rows(q.Unique("dim_location", "place"), tables)) == []
