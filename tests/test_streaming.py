import random

from pyspark.sql import functions as F

from builders import NOON, at, obs, observations, silver, values
from cirrolake.operators.fact import fact_from_same_silver
from cirrolake.operators.silver import to_silver
from cirrolake.sinks.tables import append_bronze
from cirrolake.sources.tables import read_bronze, read_silver
from cirrolake.streaming import intake, merge, windows
from test_stages import body, land


def stream_of(spark, df, folder, files=1, per_trigger=None):
    df.repartition(files).write.mode("append").parquet(folder)
    reader = spark.readStream.schema(df.schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def test_each_file_is_taken_once(spark, path):
    def run():
        intake.start_intake(spark, path("landing"), path("bronze"), path("checkpoint"), ingested_at=NOON).awaitTermination()
        return read_bronze(spark, path("bronze")).count()

    land(path("landing"), body("A", 1, 2))
    assert run() == 2
    assert run() == 2
    land(path("landing"), body("B", 1))
    assert run() == 3


def test_history_intake(spark, path):
    land(path("landing"), {"place_name": "A", "lat": 1.5, "lon": 2.5, "data": [{"ts": 5, "wind_gust_spd": 1}]})
    intake.start_intake(spark, path("landing"), path("bronze"), path("checkpoint"), feed="history").awaitTermination()
    assert values(read_bronze(spark, path("bronze")), "source", "lat") == [("weatherbit_historical", 1.5)]


def test_both_feeds_and_a_batch_share_one_bronze(spark, path):
    land(path("now"), body("A", 1, 2))
    land(path("past"), {"place_name": "A", "lat": 1.5, "lon": 2.5, "data": [{"ts": 5, "wind_gust_spd": 1}]})
    for _ in range(2):
        for feed, landing in (("current", "now"), ("history", "past")):
            intake.start_intake(spark, path(landing), path("bronze"), path(feed), feed, NOON).awaitTermination()
    assert read_bronze(spark, path("bronze")).count() == 3
    append_bronze(read_bronze(spark, path("bronze")).limit(1), path("bronze"), "extra")
    assert read_bronze(spark, path("bronze")).count() == 4


def random_rows(n=300, seed=5):
    rng = random.Random(seed)
    return [
        obs(id=str(i), place=rng.choice("AAABC"), observed_at=at(rng.randrange(24), rng.randrange(60), day=rng.choice((28, 29))),
            ingested_at=at(12, rng.randrange(5)), temperature=float(i), weather_code=1.0, weather_description="x")
        for i in range(n)
    ]


def test_merge_equals_full_refresh(spark, path):
    rows = observations(spark, *random_rows(), obs(place=None), obs(observed_at=None))
    stream = stream_of(spark, rows, path("in"), files=5, per_trigger=1)
    query = merge.start_merge(stream, path("silver"), path("checkpoint"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 5
    assert values(read_silver(spark, path("silver"))) == values(to_silver(rows))


def test_late_rows_touch_their_date_only(spark, path):
    early = observations(spark, obs(id="1", observed_at=at(1, 30, day=28)), obs(id="2", observed_at=at(1, day=29)))
    assert len(merge.merge_silver(early, path("silver"), path("s1"))) == 2
    late = observations(spark, obs(id="0", observed_at=at(1, 10, day=28)), obs(id="9", observed_at=at(1, 50, day=28)))
    dates = merge.merge_silver(late, path("silver"), path("s2"))
    assert [d.day for d in dates] == [28]
    assert values(read_silver(spark, path("silver")), "id") == [("0",), ("2",)]
    assert merge.merge_silver(late.limit(0), path("silver"), path("s3")) == []


def test_fact_follows(spark, path):
    rows = random_rows()
    for n, part in enumerate((rows[:150], rows[150:])):
        dates = merge.merge_silver(observations(spark, *part), path("silver"), path(f"s{n}"))
        merge.refresh_fact(spark, path("silver"), path("fact"), path(f"f{n}"), dates)
    assert values(merge.read_fact(spark, path("fact"))) == values(fact_from_same_silver(silver(spark, *rows)))


def test_first_arrivals(spark, path):
    rows = observations(spark, *random_rows())
    stream = stream_of(spark, rows, path("in"))
    out = windows.first_arrivals(stream).select("id", "place", "hour")
    windows.start_append(out, path("out"), path("checkpoint")).awaitTermination()
    got = spark.read.parquet(path("out"))
    assert values(got, "place", "hour") == values(to_silver(rows).select("place", F.date_trunc("hour", "observed_at").alias("hour")))


def test_hourly_windows_close_behind_the_watermark(spark, path):
    rows = observations(spark, *[obs(id=str(h), observed_at=at(h, 30), temperature=float(h)) for h in range(10)])
    stream = stream_of(spark, rows, path("in"))
    windows.start_append(windows.hourly_weather(stream, "2 hours"), path("out"), path("checkpoint")).awaitTermination()
    got = spark.read.parquet(path("out"))
    # The newest time is 9:30, so windows that end by 7:30 are final.
    assert values(got.select(F.hour("hour_start"), "avg_temperature_celsius", "observation_count")) == [
        (h, float(h), 1) for h in range(7)
    ]
