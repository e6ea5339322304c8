import datetime as dt
import hashlib

from builders import at, obs, observations, silver, values
from cirrolake.operators.dimensions import dim_date, dim_location, dim_weather
from cirrolake.operators.fact import fact_from_same_silver, fact_hourly_weather
from cirrolake.operators.silver import add_features
from cirrolake.schemas import GOLD


def joined(s, **kwargs):
    return fact_hourly_weather(s, dim_location(s), dim_date(s), dim_weather(s), **kwargs)


def test_latest_location(spark):
    s = silver(
        spark,
        obs(id="1", observed_at=at(1), ingested_at=at(2), latitude=1.0, api_city="old"),
        obs(id="2", observed_at=at(0), ingested_at=at(3), latitude=2.0, api_city="new"),
        obs(id="3", observed_at=at(2), ingested_at=None, latitude=3.0),
    )
    key = hashlib.md5(b"A").hexdigest()
    assert values(dim_location(s), "location_key", "place", "api_city", "latitude") == [(key, "A", "new", 2.0)]


def test_dates(spark):
    s = silver(spark, obs(observed_at=at(23, 30, day=31)), obs(observed_at=at(1, day=31)), obs(observed_at=at(1, day=30)))
    assert values(dim_date(s)) == [
        (20251030, dt.date(2025, 10, 30), 2025, 4, 10, "October", 30, 4, "Thursday", False),
        (20251031, dt.date(2025, 10, 31), 2025, 4, 10, "October", 31, 5, "Friday", False),
    ]


def test_null_weather(spark):
    """A null pair is a dimension row, but the fact's join does not find it."""
    s = silver(
        spark,
        obs(place="A", weather_code=800.0, weather_description="Clear"),
        obs(place="B"),
        obs(place="C", weather_code=800.0),
        obs(place="D", weather_description="Clear"),
    )
    assert dim_weather(s).count() == 4
    keys = values(joined(s), "weather_key")
    assert sorted(k is None for (k,) in keys) == [False, True, True, True]
    assert values(joined(s)) == values(fact_from_same_silver(s))


def test_schemas(spark):
    s = silver(spark, obs())
    tables = {
        "dim_location": dim_location(s),
        "dim_date": dim_date(s),
        "dim_weather": dim_weather(s),
        "fact_hourly_weather": fact_from_same_silver(s),
    }
    for name, table in tables.items():
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in GOLD[name]], name


def many(spark):
    """Observations that were not deduplicated."""
    rows = [
        obs(id=None if i == 0 else str(i), observed_at=at(3, i), temperature=float(i), humidity=None,
            wind_speed=float(i % 4), precipitation=0.5 if i else None, weather_code=-0.0 if i % 2 else 0.0,
            weather_description="x")
        for i in range(10)
    ]
    return add_features(observations(spark, *rows))


def test_aggregates(spark):
    s = many(spark)
    row = joined(s).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.avg_temperature_celsius, row.avg_humidity_percent, row.max_wind_speed_ms) == (4.5, None, 3.0)
    assert (row.total_precipitation_mmh, row.observation_count) == (4.5, 9)
    assert values(joined(s, scale=3)) == values(joined(s)) == values(fact_from_same_silver(s))


def test_orphans_keep_their_rows(spark):
    s = silver(spark, obs(place="A", id="1"), obs(place="B", id="2"))
    only_a = dim_location(s).where("place = 'A'")
    fact = fact_hourly_weather(s, only_a, dim_date(s), dim_weather(s))
    assert sorted((r.location_key is None, r.observation_count) for r in fact.collect()) == [(False, 1), (True, 1)]


def test_counts_add_up(spark):
    s = silver(spark, *[obs(place=p, id=p, observed_at=at(h)) for p in "ABC" for h in range(5)], obs(id=None, place="D"))
    total = fact_from_same_silver(s).agg({"observation_count": "sum"}).first()[0]
    assert total == s.where("id is not null").count() == 15
