import datetime as dt
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from builders import NOON, at, obs, observations, silver, values
from cirrolake.operators.quality import QualityError
from cirrolake.plans import stages
from cirrolake.session import s3_settings, scratch_dir
from cirrolake.sinks import publish as pub
from cirrolake.sinks import tables as sink
from cirrolake.sinks.merge import path_exists, replace_partitions
from cirrolake.sources import tables as src
from cirrolake.streaming.merge import merge_silver


def land(folder, *bodies):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{len(os.listdir(folder))}.json", "w", encoding="utf-8") as f:
        f.writelines(json.dumps(b, ensure_ascii=False) + "\n" for b in bodies)


def body(place, *hours, day=30, **more):
    weather = {"code": 800, "description": "Clear"}
    data = [
        {"ts": int(at(h, day=day).timestamp()), "lat": 21.5, "lon": 105.5, "temp": 20 + h, "weather": weather} | more
        for h in hours
    ]
    return {"place_name": place, "data": data}


def test_whole_run(spark, path):
    lake, landing = stages.Lake(path("lake")), path("landing")
    land(landing, body("A", 1, 2, 2), body("B", 1), {"place_name": "C"})
    gold = stages.run_all(spark, landing, lake, NOON)
    assert values(gold.dim_location, "place") == [("A",), ("B",)]
    assert gold.fact_hourly_weather.count() == 3
    assert spark.table("fact_hourly_weather").count() == 3
    # Both duplicates of the second hour are still in the raw layer.
    assert src.read_bronze(spark, lake.bronze).count() == 4
    assert src.read_bronze(spark, lake.bronze, since=NOON.date() + dt.timedelta(days=1)).count() == 0


def test_failing_run_changes_nothing(spark, path):
    lake = stages.Lake(path("lake"))
    land(path("good"), body("A", 1))
    stages.run_all(spark, path("good"), lake, NOON)
    before = pub.published_run(spark, lake.gold)
    land(path("bad"), body("B", 1, temp=99))
    with pytest.raises(QualityError, match="avg_temperature_celsius: 1"):
        stages.run_all(spark, path("bad"), lake, NOON)
    assert pub.published_run(spark, lake.gold) == before
    assert values(stages.read_gold(spark, lake).dim_location, "place") == [("A",)]
    assert values(spark.table("dim_location"), "place") == [("A",)]


def test_catalog_views_move(spark, path):
    lake = stages.Lake(path("lake"))
    location = path("warehouse")
    spark.sql(f"CREATE DATABASE marts LOCATION '{location}'")
    try:
        land(path("one"), body("A", 1))
        stages.run_all(spark, path("one"), lake, NOON, database="marts")
        assert spark.table("marts.dim_location").count() == 1
        land(path("two"), body("B", 1))
        stages.run_all(spark, path("two"), lake, NOON, database="marts")
        assert values(spark.table("marts.dim_location"), "place") == [("A",), ("B",)]
    finally:
        spark.sql("DROP DATABASE marts CASCADE")


def test_backfill_range(spark, path):
    lake = stages.Lake(path("lake"))
    history = {"place_name": "A", "lat": 1.5, "lon": 2.5, "data": [
        {"ts": int(at(h, day=d).timestamp()), "wind_gust_spd": 3} for d in (28, 29, 30) for h in (0, 23)
    ]}
    land(path("history"), history)
    assert stages.backfill(spark, path("history"), lake, NOON, dt.date(2025, 10, 29), dt.date(2025, 10, 29)) == 2
    rows = src.read_bronze(spark, lake.bronze)
    assert values(rows, "source", "lat") == [("weatherbit_historical", 1.5)] * 2
    stages.build_silver(spark, lake)
    assert values(stages.current_silver(spark, lake), "wind_gust", "observation_hour") == [(3.0, 0), (3.0, 23)]


def test_live_update_is_repeatable_and_finishes_leftovers(spark, path):
    lake = stages.Lake(path("lake"))
    land(path("one"), body("A", 1, 2))
    stages.ingest_current(spark, path("one"), lake, NOON)
    assert [d.day for d in stages.update_live(spark, lake, NOON.date())] == [30]
    land(path("two"), body("A", 3, day=29), body("B", 1))
    later = NOON + dt.timedelta(days=1)
    stages.ingest_current(spark, path("two"), lake, later)
    # A run before died after it had staged the new Silver partition of one hour.
    silver_path, stage = f"{lake.live}/weather_observations", f"{lake.live}/stages/silver"
    leftover = src.read_silver(spark, silver_path, keep_date=True).where("hour(observed_at) = 1")
    leftover.write.partitionBy("observed_date").parquet(stage)
    assert [d.day for d in stages.update_live(spark, lake, later.date())] == [29, 30]
    assert not path_exists(spark, stage)
    live = stages.read_live(spark, lake)
    assert values(live.fact_hourly_weather, "date_key", "observation_hour") == [
        (20251029, 3), (20251030, 1), (20251030, 1), (20251030, 2)
    ]
    # Everything again, from the first batch on.
    stages.update_live(spark, lake, NOON.date())
    live = stages.read_live(spark, lake)
    assert values(live.dim_location, "place") == [("A",), ("B",)]
    fact = live.fact_hourly_weather
    stages.build_silver(spark, lake)
    assert values(fact) == values(stages.gold_tables(stages.current_silver(spark, lake)).fact_hourly_weather)


def test_nothing_landed(spark, path):
    lake = stages.Lake(path("lake"))
    land(path("landing"), {"place_name": "A", "data": []})
    assert stages.ingest_current(spark, path("landing"), lake, NOON) == 0
    assert not path_exists(spark, lake.bronze)


def test_silver_without_rows_is_not_published(spark, path):
    lake = stages.Lake(path("lake"))
    land(path("landing"), {"place_name": "A", "data": [{"ts": "never"}]})
    assert stages.ingest_current(spark, path("landing"), lake, NOON) == 1
    assert stages.build_silver(spark, lake) is None
    assert not path_exists(spark, f"{lake.silver}/{pub.LOG}")


def test_silver_schema_is_enforced(spark, path):
    with pytest.raises(TypeError):
        sink.write_silver(silver(spark, obs()).withColumn("month", F.lit("x")), path("silver"))


def test_silver_partitions(spark, path):
    s = silver(spark, *[obs(id=str(d), observed_at=at(1, day=d)) for d in (28, 29, 30)])
    assert sink.write_silver(s, path("silver")) == 3
    assert values(src.read_silver(spark, path("silver"))) == values(s)
    one = src.read_silver(spark, path("silver"), [dt.date(2025, 10, 29)])
    assert values(one, "id") == [("29",)]
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(observed_date" in scan or "PartitionFilters: [observed_date" in scan


def test_schema_merge(spark, path):
    a = spark.createDataFrame([("1", NOON.date())], "observation_id string, ingest_date date")
    b = spark.createDataFrame([("2", NOON.date(), "x")], "observation_id string, ingest_date date, station string")
    sink.append_bronze(a, path("bronze"))
    sink.append_bronze(b, path("bronze"))
    assert values(src.read_bronze(spark, path("bronze"), merge=True), "observation_id", "station") == [("1", None), ("2", "x")]


def partitions(spark, rows):
    return spark.createDataFrame(rows, "day int, v string")


def test_replace_partitions(spark, path):
    partitions(spark, [(1, "a"), (2, "b"), (3, "c")]).write.partitionBy("day").parquet(path("t"))
    table = spark.read.schema("v string, day int").parquet(path("t"))
    # The rows come from the table itself.
    changed = table.where("day = 2").selectExpr("upper(v) v", "day")
    replace_partitions(changed, path("t"), path("stage"), "day")
    assert values(spark.read.parquet(path("t")), "day", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert not os.path.exists(path("stage"))


def test_interrupted_replacement_is_finished(spark, path):
    """The table lost a partition half-way; the complete stage has it, and newer input must not be taken instead."""
    partitions(spark, [(1, "a")]).write.partitionBy("day").parquet(path("t"))
    partitions(spark, [(2, "staged")]).write.partitionBy("day").parquet(path("stage"))
    replace_partitions(partitions(spark, [(2, "wrong")]), path("t"), path("stage"), "day")
    assert values(spark.read.parquet(path("t")), "day", "v") == [(1, "a"), (2, "staged")]


def test_incomplete_stage_is_redone(spark, path):
    partitions(spark, [(1, "a")]).write.partitionBy("day").parquet(path("t"))
    os.makedirs(path("stage") + "/day=9")
    replace_partitions(partitions(spark, [(1, "b")]), path("t"), path("stage"), "day")
    assert values(spark.read.parquet(path("t")), "day", "v") == [(1, "b")]


def test_publish_log(spark, path):
    for run_id in ("b", "a"):
        pub.publish_run(spark, path("g"), run_id)
    assert pub.published_run(spark, path("g")) == "a"


def test_csv_export(spark, path):
    sink.export_csv(spark.createDataFrame([("Hà Nội, thủ đô", 1.5)], "name string, latitude double"), path("csv"))
    assert values(spark.read.csv(path("csv"), header=True)) == [("Hà Nội, thủ đô", "1.5")]


def test_staging_view(spark):
    assert src.stage_silver(observations(spark, obs(id="v")), "stg_test").count() == 1
    assert spark.sql("SELECT id FROM stg_test").first()[0] == "v"


def test_settings():
    got = s3_settings("http://store:9000", "k", "s")
    assert got["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert got["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert s3_settings("https://x", "k", "s")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_scratch_follows_the_session(monkeypatch):
    removed = []
    monkeypatch.setattr("cirrolake.session.remove_at_exit", lambda _, folder: removed.append(folder))
    cluster = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared/", "spark.sql.warehouse.dir": "hdfs://w"})
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first.startswith("hdfs://shared/cirrolake/x-") and first != second
    bare = SimpleNamespace(conf={"spark.sql.warehouse.dir": "hdfs://w"})
    assert scratch_dir(bare, "x").startswith("hdfs://w/cirrolake/x-")
    assert len(removed) == 3


def test_a_failing_live_batch_changes_nothing(spark, path):
    lake = stages.Lake(path("lake"))
    land(path("one"), body("A", 1, 2))
    stages.ingest_current(spark, path("one"), lake, NOON)
    stages.update_live(spark, lake, NOON.date())
    before = values(stages.read_live(spark, lake).fact_hourly_weather)
    land(path("two"), body("A", 3, temp=99))
    later = NOON + dt.timedelta(days=1)
    stages.ingest_current(spark, path("two"), lake, later)
    for _ in range(2):
        with pytest.raises(QualityError, match="avg_temperature_celsius: 1"):
            stages.update_live(spark, lake, later.date())
        assert values(stages.read_live(spark, lake).fact_hourly_weather) == before


def test_stage_files_do_not_multiply_by_tasks(spark, path):
    rows = observations(spark, *[obs(id=str(i), observed_at=at(i % 24, day=1 + i % 20)) for i in range(480)])
    merge_silver(rows.repartition(16), path("silver"), path("stage"))
    files = sum(len([f for f in names if f.endswith(".parquet")]) for _, _, names in os.walk(path("silver")))
    assert files <= 40


def test_a_landed_file_is_taken_once(spark, path):
    lake, landing = stages.Lake(path("lake")), path("landing")
    land(landing, body("A", 1, 2))
    stages.run_all(spark, landing, lake, NOON)
    stages.run_all(spark, landing, lake, NOON + dt.timedelta(hours=1))
    assert src.read_bronze(spark, lake.bronze).count() == 2
    land(landing, body("B", 1))
    assert stages.ingest_current(spark, landing, lake, NOON) == 1
