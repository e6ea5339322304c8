"""The plans that the results come from: shuffles, pushdown, pruning, no Python in the way."""

import re

import pytest

from builders import at, bronze, obs, silver
from cirrolake.operators.dimensions import dim_date, dim_location, dim_weather
from cirrolake.operators.fact import fact_from_same_silver, fact_hourly_weather
from cirrolake.operators.silver import bronze_to_silver
from cirrolake.plans import dashboard as dash
from cirrolake.plans import questions, stages
from cirrolake.sinks import publish as pub
from cirrolake.sinks import tables as sink
from cirrolake.sources import tables as src
from workload.queries import QUERIES


def plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def shuffles(text):
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (hash|range|round|Single|REBAL)", text))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = stages.Lake(str(tmp_path_factory.mktemp("lake")))
    rows = [
        obs(id=f"{p}{d}{h}", place=p, observed_at=at(h, day=d), weather_code=1.0, weather_description="x", temperature=1.0)
        for p in "AB" for d in (28, 29, 30) for h in range(3)
    ]
    run_id = pub.new_run_id()
    sink.write_silver(silver(spark, *rows), pub.run_path(lake.silver, run_id))
    pub.publish_run(spark, lake.silver, run_id)
    stages.build_gold(spark, lake)
    return lake


def test_silver_has_one_shuffle_and_one_parse(spark, path):
    bronze(spark, {"place_name": "A", "ts": 1761800400}).write.partitionBy("ingest_date").parquet(path("b"))
    text = plan(bronze_to_silver(src.read_bronze(spark, path("b"))))
    assert shuffles(text) == 1
    assert text.count("from_json") == 1
    assert "ReadSchema: struct<observation_id:string,source:string,raw_payload:string,_ingested_at:timestamp>" in text


def test_fact_without_joins(spark, lake):
    text = plan(fact_from_same_silver(stages.current_silver(spark, lake)))
    assert "Join" not in text and shuffles(text) == 1


def test_small_dimensions_are_broadcast_by_size(spark, lake):
    s, g = stages.current_silver(spark, lake), stages.read_gold(spark, lake)
    text = plan(fact_hourly_weather(s, g.dim_location, g.dim_date, g.dim_weather))
    assert text.count("BroadcastHashJoin") == 3 and shuffles(text) == 1


def test_large_dimensions_are_not_broadcast(spark, lake):
    s, g = stages.current_silver(spark, lake), stages.read_gold(spark, lake)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = fact_hourly_weather(s, g.dim_location, g.dim_date, g.dim_weather)
        text = plan(fact)
        assert "Broadcast" not in text and "SortMergeJoin" in text
        assert fact.count() == g.fact_hourly_weather.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_dates_prune_the_fact(spark, lake):
    day = at(0, day=29).date()
    text = plan(dash.average_temperature(stages.read_gold(spark, lake), (day, day)))
    assert "dynamicpruning" in text


def test_columns_are_pruned(spark, lake):
    text = plan(dash.highest_wind(stages.read_gold(spark, lake)))
    assert "ReadSchema: struct<max_wind_speed_ms:double>" in text


def test_recent_hours_prune_silver(spark, lake):
    path = pub.run_path(lake.silver, pub.published_run(spark, lake.silver))
    s = src.read_silver(spark, path, keep_date=True)
    recent = questions.recent_trend(s, 2, partition=src.SILVER_PARTITION)
    recent.collect()
    text = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*observed_date#\d+ >= (Reused)?Subquery", text)


def test_top_five_does_not_sort_everything(spark, lake):
    text = plan(dash.highest_temperature(stages.read_gold(spark, lake)))
    assert "TakeOrderedAndProject" in text


def test_dimensions_are_cut_before_the_shuffle(spark, lake):
    s = stages.current_silver(spark, lake)
    assert plan(dim_location(s)).count("WindowGroupLimit") == 2
    for dimension in (dim_date(s), dim_weather(s)):
        text = plan(dimension)
        assert text.count("HashAggregate") == 2 and shuffles(text) == 1


def test_no_python_in_any_plan(spark, tmp_path_factory):
    for name in ("silver_full", "fact_hourly", "vs_7day_avg", "metadata_merge", "detail_table", "dq_summary"):
        text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_the_detail_table_reads_the_newest_dates_only(spark, lake):
    """Two dates hold ten rows: six on the last one, four of the one before it are needed."""
    gold = stages.read_gold(spark, lake)
    detail = dash.detail_table(gold, limit=10, stored=True)
    text = plan(detail)
    assert re.search(r"PartitionFilters: \[[^\]]*array_contains\((Reused)?Subquery", text)
    assert dash.newest_date_keys(gold, limit=10).first()["keys"] == [20251029, 20251030]
    assert detail.collect() == dash.detail_table(gold, limit=10).collect()
    counts = plan(dash.newest_date_keys(gold, limit=10))
    assert "ReadSchema: struct<>" in counts
    # Fewer rows than wanted, dates that are filtered, and places, for which row counts say nothing.
    assert dash.newest_date_keys(gold, limit=19).first()["keys"] is None
    day = at(0, day=29).date()
    for how in ({"limit": 19}, {"limit": 4, "dates": (day, day)}, {"limit": 4, "places": ["A"]}):
        assert dash.detail_table(gold, stored=True, **how).collect() == dash.detail_table(gold, **how).collect()


def test_past_week_is_split_by_day(spark, lake):
    """The past-week window is split by day, however long a place's history is, and a day's total travels once."""
    text = plan(questions.against_past_week(stages.current_silver(spark, lake)))
    assert "sequence" not in text and text.count("Generate") == 1
    assert re.search(r"Exchange hashpartitioning\(place#\d+, _day#\d+L?", text)
    assert "SinglePartition" not in text
