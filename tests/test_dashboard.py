import datetime as dt

import pytest
from pyspark.sql import functions as F

from builders import at, obs, silver, values
from cirrolake.plans import dashboard as dash
from cirrolake.plans.stages import gold_tables


@pytest.fixture(scope="module")
def gold(spark):
    rows = []
    for i, place in enumerate("ABCDEFG"):
        for day in (28, 29, 30):
            rows.append(
                obs(id=f"{place}{day}", place=place, observed_at=at(i, day=day), temperature=float(10 * i + day),
                    humidity=None if place == "G" else 50.0 + i, wind_speed=float(i), cloud_cover=10.0,
                    precipitation=0.25, weather_code=800.0 + day % 2, weather_description=f"w{day % 2}",
                    latitude=float(i), longitude=1.0)
            )
    return gold_tables(silver(spark, *rows))


def test_kpis(gold):
    assert values(dash.total_locations(gold)) == [(7,)]
    assert values(dash.average_temperature(gold)) == [(59.0,)]
    assert values(dash.average_humidity(gold)) == [(52.5,)]
    assert values(dash.average_cloud_coverage(gold)) == [(10.0,)]
    assert values(dash.highest_wind(gold)) == [(6.0,)]
    assert values(dash.location_map(gold, places=["B"])) == [("B", 1.0, 1.0)]


def test_filters(gold):
    day = dt.date(2025, 10, 29)
    assert values(dash.average_temperature(gold, (day, day), ["A", "C"])) == [(39.0,)]
    assert values(dash.average_temperature(gold, (day, None), ["A"])) == [(29.5,)]
    assert values(dash.average_temperature(gold, (None, day), ["A"])) == [(28.5,)]
    assert values(dash.total_locations(gold, ["A", "?"])) == [(1,)]
    assert values(dash.average_temperature(gold, None, [])) == [(None,)]
    assert values(dash.average_temperature(gold, scale=3)) == [(59.0,)]


def test_trend(gold):
    assert values(dash.daily_trend(gold, places=["A", "B"])) == [
        (dt.date(2025, 10, d), float(d + 5), 0.5) for d in (28, 29, 30)
    ]


def test_top_and_bottom(gold):
    top = [tuple(r) for r in dash.highest_temperature(gold).collect()]
    assert top == [(p, 10.0 * i + 29) for i, p in reversed(list(enumerate("ABCDEFG")))][:5]
    assert [r.place for r in dash.lowest_temperature(gold).collect()] == list("ABCDE")
    # A place without humidity comes last in both directions.
    assert [r.place for r in dash.most_humid(gold, n=7).collect()] == list("FEDCBAG")
    assert [r.place for r in dash.least_humid(gold, n=7).collect()] == list("ABCDEFG")
    assert [r.value for r in dash.strongest_wind(gold, n=2).collect()] == [6.0, 5.0]
    assert [r.value for r in dash.weakest_wind(gold, n=2, places=["C", "D", "E"]).collect()] == [2.0, 3.0]


def test_distribution(gold):
    got = values(dash.weather_distribution(gold, places=["A"]))
    assert got == [("A", "w0", 2, 2 / 3), ("A", "w1", 1, 1 / 3)]


def test_detail(gold):
    rows = dash.detail_table(gold)
    assert rows.columns == ["Date", "Hour", "Location", "Temperature (°C)", "Weather Description", "Observation Count"]
    assert [(r.Date.day, r.Hour) for r in rows.collect()] == [(d, h) for d in (30, 29, 28) for h in range(6, -1, -1)]
    assert rows.count() == 21 and dash.detail_table(gold, limit=4).count() == 4
    day = dt.date(2025, 10, 28)
    some = dash.detail_table(gold, (day, day), ["B", "C"]).collect()
    assert [tuple(r) for r in some] == [(day, 2, "C", 48.0, "w0", 1), (day, 1, "B", 38.0, "w0", 1)]


def test_orphan_facts_are_one_group(gold):
    """Facts whose keys are in no dimension are averaged together, whatever their keys."""
    fact = gold.fact_hourly_weather
    stray = fact.withColumn("location_key", F.concat(F.lit("x"), "location_key"))
    mixed = dash.Gold(gold.dim_location, gold.dim_date, gold.dim_weather, stray)
    assert values(dash.by_place(mixed, "avg_temperature_celsius", "avg")) == [(None, 59.0)]
    assert values(dash.by_place(mixed, "max_wind_speed_ms", "max")) == [(None, 6.0)]
