import json

from pyspark.sql import functions as F

from builders import NOON, bronze, responses, values
from cirrolake.operators.bronze import current_to_bronze, history_to_bronze, union_feeds
from cirrolake.operators.locations import attach_coordinates, failed_geocodes, names_within, place_names
from cirrolake.operators.silver import observations, quarantine
from cirrolake.schemas import BRONZE
from cirrolake.sources.locations import read_boundaries, read_locations, read_names
from cirrolake.sources.responses import (
    current_observations,
    geocoded,
    history_observations,
    read_responses,
    rejected_elements,
    rejected_responses,
)


def payloads(bronze_rows):
    return [json.loads(r.raw_payload) for r in bronze_rows.collect()]


def current(spark, *bodies):
    return current_to_bronze(current_observations(responses(spark, *bodies)), NOON)


def history(spark, *bodies):
    return history_to_bronze(history_observations(responses(spark, *bodies)), NOON)


def test_current_responses(spark):
    body = {"place_name": "Hà Nội", "count": 2, "data": [
        {"ts": 1, "lat": 21.5, "lon": 105.25, "city_name": "Hanoi", "rh": None, "sources": ["a", {"b": 1}]},
        {"ts": 2, "lat": 21.5, "lon": 105.25, "place_name": "theirs"},
    ]}
    rows = current(spark, body)
    assert [f.dataType for f in rows.schema] == [f.dataType for f in BRONZE] and rows.columns == BRONZE.names
    one, two = sorted(payloads(rows), key=lambda p: p["ts"])
    # Every key is kept, also nulls and keys that Silver does not know; the name is ours.
    assert one == body["data"][0] | {"place_name": "Hà Nội"}
    assert two["place_name"] == "Hà Nội"
    assert "Hà Nội" in rows.first().raw_payload
    assert values(rows, "source", "lat", "lon", "ingest_date") == [("weatherbit_current", 21.5, 105.25, NOON.date())] * 2


def test_responses_without_rows(spark):
    bodies = [{"place_name": "A"}, {"place_name": "A", "data": []}, {"place_name": "A", "data": None}, "<html>", "[]"]
    assert current(spark, *bodies).count() == 0
    assert history(spark, *bodies).count() == 0
    assert [r.body for r in rejected_responses(responses(spark, *bodies)).collect()] == ["<html>"]


def test_bad_elements_and_repeated_keys(spark):
    mixed = '{"place_name": "A", "data": [{"ts": 1, "lat": 1.5, "lat": 2.5}, "text", null, [3], {"ts": 2}]}'
    assert sorted(p["ts"] for p in payloads(current(spark, mixed))) == [1, 2]
    assert sorted(p["ts"] for p in payloads(history(spark, mixed))) == [1, 2]
    assert [p.get("lat") for p in payloads(current(spark, mixed)) if p["ts"] == 1] == [2.5]
    assert len(rejected_elements(responses(spark, mixed)).collect()) == 3
    twice = '{"place_name": "A", "lat": 1, "lat": 2, "data": [{"ts": 1, "temp": 3, "temp": 4}]}'
    assert [(p["lat"], p["temp"]) for p in payloads(history(spark, twice))] == [(2, 4)]


def test_history_metadata(spark):
    body = {"place_name": "Huế", "lat": 16.5, "lon": 107.5, "timezone": "Asia", "station": {"id": [1, 2.5]}, "data": [
        {"ts": 1, "temp": 20},
        {"ts": 2, "lat": None},
        {"ts": 3, "lat": 1.5, "timezone": "UTC"},
    ]}
    rows = history(spark, body)
    one, two, three = sorted(payloads(rows), key=lambda p: p["ts"])
    meta = {"lat": 16.5, "lon": 107.5, "timezone": "Asia", "station": {"id": [1, 2.5]}, "place_name": "Huế",
            "app_temp": None, "aqi": None}
    assert one == meta | {"ts": 1, "temp": 20}
    assert two == meta | {"ts": 2, "lat": None}
    assert three == meta | {"ts": 3, "lat": 1.5, "timezone": "UTC"}
    # A null coordinate gives no id.
    ids = {json.loads(r.raw_payload)["ts"]: r.observation_id for r in rows.collect()}
    assert ids[2] is None and ids[1] and ids[3]


def test_history_gust(spark):
    body = {"place_name": "A", "data": [
        {"ts": 1, "wind_gust_spd": 7.5},
        {"ts": 2, "wind_gust_spd": 7.5, "gust": 1},
        {"ts": 3, "gust": 2, "app_temp": 5, "aqi": 9},
        {"ts": 4, "wind_gust_spd": None, "gust": 3},
    ]}
    rows = sorted(payloads(history(spark, body)), key=lambda p: p["ts"])
    assert [r.get("gust") for r in rows] == [7.5, 7.5, 2, None]
    assert all("wind_gust_spd" not in r for r in rows)
    assert (rows[2]["app_temp"], rows[2]["aqi"], rows[0]["app_temp"]) == (5, 9, None)


def test_id_time_text(spark):
    """The id takes the time as it is written."""
    rows = current(spark, {"place_name": "A", "data": [{"lat": 1.5, "lon": 2.5, "ts": t} for t in (5, "5")]})
    assert rows.select("observation_id").distinct().count() == 1


def test_union_of_feeds(spark):
    a = bronze(spark, {"ts": 1})
    b = bronze(spark, {"ts": 2}, source="weatherbit_historical").withColumn("station", F.lit("s"))
    both = union_feeds(a, b)
    assert values(both, "source", "station") == [("weatherbit_current", None), ("weatherbit_historical", "s")]


def test_payload_shapes(spark):
    rows = bronze(
        spark,
        {"place_name": "A", "ts": 1761800400, "temp": 20, "weather": {"code": 804, "description": "Clouds", "icon": "c"}},
        {"place_name": "A", "ts": "1761800400", "weather": "cloudy"},
        {"place_name": "A", "ts": 1761800400.0, "weather": [1]},
        {"place_name": "A", "ts": 1761800400, "temp": "warm", "unknown": {"x": 1}},
        '{"place_name": "A", "ts": ',
        None,
    )
    got = observations(rows)
    assert values(got.where("place = 'A'").select(F.unix_seconds("observed_at").alias("s")).distinct()) == [(1761800400,)]
    assert values(got.where("place is not null"), "id", "temperature", "weather_code", "weather_description") == [
        ("0", 20.0, 804.0, "Clouds"), ("1", None, None, None), ("2", None, None, None), ("3", None, None, None),
    ]
    # Only text that is no JSON goes aside, not a field of another type than usual.
    assert values(quarantine(rows), "observation_id") == [("4",)]


def test_location_files(spark, path):
    places = path("places.csv")
    with open(places, "w", encoding="utf-8") as f:
        f.write("name,latitude,longitude\nThủ đô Hà Nội,21.0283334,105.854041\nNowhere,,\n")
    assert values(read_locations(spark, places)) == [("Nowhere", None, None), ("Thủ đô Hà Nội", 21.0283334, 105.854041)]
    wards = path("wards.csv")
    with open(wards, "w", encoding="utf-8") as f:
        f.write('tenhc,latitude,longitude\n"Xã A, B",15.1,108.8\n')
    assert values(read_locations(spark, wards, key="tenhc")) == [("Xã A, B", 15.1, 108.8)]
    names = path("names.csv")
    with open(names, "w", encoding="utf-8") as f:
        f.write("tenhc\nXã A\nXã B\n")
    assert values(read_names(spark, names, "tenhc")) == [("Xã A",), ("Xã B",)]


def test_boundaries(spark, path):
    file = path("boundaries.csv")
    with open(file, "w", encoding="utf-8") as f:
        f.write("id,tentinh,tenhc\n1,tỉnh Quảng Ngãi,Xã A\n2,tỉnh Quảng Ngãi,Xã B\n3,Tỉnh Quảng Ngãi,Xã C\n4,thành phố Huế,Xã D\n")
    rows = read_boundaries(spark, file, ["id", "tentinh", "tenhc"])
    assert values(names_within(rows, "tỉnh Quảng Ngãi")) == [("Xã A",), ("Xã B",)]
    assert values(place_names(rows)) == [("Quảng Ngãi",), ("Quảng Ngãi",), ("Thành phố Huế",)]


def test_geocoding(spark):
    bodies = {"A": '[{"lat": "21.5", "lon": "105.5", "name": "x"}, {"lat": "0", "lon": "0"}]', "B": "[]", "C": "busy",
              "D": '[{"lat": "north"}]', "E": None}
    answers = spark.createDataFrame(list(bodies.items()), "name string, body string")
    names = spark.createDataFrame([(n,) for n in [*bodies, "F"]], "name string")
    got = attach_coordinates(names, geocoded(answers))
    assert values(got)[0] == ("A", 21.5, 105.5)
    assert values(failed_geocodes(got)) == [(5,)]


def test_whole_file_documents(spark, path):
    folder = path("landing")
    import os

    os.mkdir(folder)
    for i in range(2):
        with open(f"{folder}/{i}.json", "w") as f:
            json.dump({"place_name": f"P{i}", "data": [{"ts": i}]}, f, indent=2)
    got = current_observations(read_responses(spark, folder, whole_file=True))
    assert got.count() == 2


def test_history_time_range_before_merge(spark):
    """The backfill's range is judged on the merged time: the element's `ts`, even a null one, else the metadata's."""
    from cirrolake.sources.responses import classified

    docs = responses(
        spark,
        {"place_name": "A", "ts": 150, "data": [{"temp": 1}, {"ts": 50, "temp": 2}, {"ts": None, "temp": 3}, 7]},
        {"place_name": "B", "ts": 50, "data": [{"ts": 120, "temp": 4}, {"temp": 5}]},
        "not json",
    )
    low, high = 100.0, 200.0
    seconds = F.try_variant_get(F.try_element_at("obs", F.lit("ts")), "$", "string").try_cast("double")
    whole = classified(docs, "history").where(F.col("reason").isNotNull() | ((seconds >= low) & (seconds < high)))
    ranged = classified(docs, "history", (low, high))
    as_rows = lambda df: sorted(map(str, df.select(F.to_json("obs").alias("obs"), "rejected", "reason").collect()))
    assert as_rows(ranged) == as_rows(whole)
    assert len(as_rows(ranged)) == 4
