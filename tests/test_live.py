"""Live tables by change rows against a full run, whichever step a run dies in, and their gate."""

import os
import random

import pytest


from builders import at, obs, observations, values
from cirrolake.operators.quality import QualityError
from cirrolake.operators.silver import to_silver
from cirrolake.plans import stages
from cirrolake.sinks import publish as pub
from cirrolake.sinks.merge import path_exists
from cirrolake.sources.tables import read_gold_table, read_silver
from cirrolake.streaming import live
from test_streaming import stream_of

SCALE = 1


def random_rows(n, seed, days=(28, 29)):
    rng = random.Random(seed)
    return [
        obs(id=f"{seed}-{i}", place=rng.choice("AAABC"), observed_at=at(rng.randrange(4), rng.randrange(60), day=rng.choice(days)),
            ingested_at=at(12, rng.randrange(5)), temperature=float(rng.randrange(30)), weather_code=float(rng.randrange(3)),
            weather_description=rng.choice("xy"), api_city=f"city {rng.randrange(9)}", latitude=1.5)
        for i in range(n)
    ]


def state(spark, tables):
    dims = live.read_dimensions(spark, tables)
    fact = read_gold_table(spark, tables.fact, "fact_hourly_weather")
    silver = read_silver(spark, tables.silver)
    return [values(silver), values(fact), *[values(dims[n]) for n in ("dim_location", "dim_date", "dim_weather")]]


def full(spark, rows):
    silver = to_silver(observations(spark, *rows))
    gold = stages.gold_tables(silver, SCALE)
    return [values(silver), values(gold.fact_hourly_weather), values(gold.dim_location), values(gold.dim_date), values(gold.dim_weather)]


def tables_at(path):
    return live.LiveTables(path("live"))


def update(spark, tables, rows):
    return live.update(tables, observations(spark, *rows), SCALE)


def test_batches_end_where_a_full_run_does(spark, path, monkeypatch):
    """Replaced versions of the dimensions go, all but those that are kept for readers."""
    monkeypatch.setattr(live, "KEPT_VERSIONS", 1)
    tables, rows = tables_at(path), []
    for seed in range(2):
        rows += random_rows(40, seed)
        assert update(spark, tables, [*rows[-40:], obs(place=None), obs(observed_at=None)])
        assert state(spark, tables) == full(spark, rows)
    assert len([f for f in os.listdir(tables.dimensions) if f.startswith("run_id=")]) == 1


def files(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def test_an_update_of_one_hour_reads_and_rewrites_that_hour(spark, path):
    tables, rows = tables_at(path), random_rows(60, 7)
    update(spark, tables, rows)
    before = {t: files(t) for t in (tables.silver, tables.fact)}
    late = obs(id="0", place="A", observed_at=at(2, 0, day=28), ingested_at=at(13), temperature=9.0, weather_code=1.0, weather_description="x")
    assert [d.day for d in update(spark, tables, [late])] == [28]
    for table, day in ((tables.silver, "observed_date=2025-10-28"), (tables.fact, "date_key=20251028")):
        changed = {f for f in before[table].keys() ^ files(table).keys()}
        assert changed and all(f"{day}/observation_hour=2/" in f for f in changed)
    assert state(spark, tables) == full(spark, [*rows, late])

    plan = live._silver_at(spark, tables, [(at(0, day=28).date(), 2)])._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "observed_date" in filters and "observation_hour" in filters

    # Rows that are there already, and rows that do not survive, rewrite nothing.
    there = files(tables.root)
    assert update(spark, tables, [late, late | {"id": "00", "observed_at": at(2, 1, day=28)}]) == []
    assert files(tables.root) == there


def test_change_rows(spark):
    old = observations(spark, obs(id="1", observed_at=at(1, 30)), obs(id="2", observed_at=at(2, 30)), obs(id="3", observed_at=at(3, 30)))
    new = observations(spark, obs(id="4", observed_at=at(1, 10)), obs(id="5", observed_at=at(2, 40)), obs(id="3", observed_at=at(3, 30)),
                       obs(id="6", observed_at=at(4)))
    assert values(live.changes_between(old, new), "op", "id") == [("insert", "4"), ("insert", "6"), ("retract", "1")]


def test_what_a_retracted_row_held_goes_with_it(spark, path):
    """A weather goes with its last row, not before. A place whose latest row goes for one that was ingested earlier falls
    back to a third row."""
    tables = live.LiveTables(path("live"), by_hour=False)
    x, y = {"weather_code": 1.0, "weather_description": "x"}, {"weather_code": 2.0, "weather_description": "y"}
    rows = [
        obs(id="1", observed_at=at(1, 30), ingested_at=at(12, 9), api_city="latest", **x),
        obs(id="2", observed_at=at(2, 30), ingested_at=at(12, 5), api_city="middle", **x),
        obs(id="3", observed_at=at(1, 10), ingested_at=at(12, 1), api_city="earlier", **y),
        obs(id="4", observed_at=at(2, 10), ingested_at=at(12, 2), api_city="last", **y),
    ]
    for part, city, codes in ((rows[:2], "latest", [1.0]), (rows[2:3], "middle", [1.0, 2.0]), (rows[3:], "last", [2.0])):
        update(spark, tables, part)
        dims = live.read_dimensions(spark, tables)
        assert values(dims["dim_location"], "api_city") == [(city,)]
        assert [c for c, in values(dims["dim_weather"], "weather_code")] == codes
    assert state(spark, tables) == full(spark, rows)


@pytest.mark.parametrize(("step", "call"), [("finish_replacement", 2), ("publish_run", 1)])
def test_a_run_that_died_is_taken_up(spark, path, monkeypatch, step, call):
    tables, rows = tables_at(path), random_rows(50, 3)
    update(spark, tables, rows[:25])
    place, calls = (pub if step == "publish_run" else live), []
    whole = getattr(place, step)

    def dies(*a, **b):
        calls.append(1)
        if step == "finish_replacement" and not path_exists(spark, f"{a[3]}/_SUCCESS"):
            calls.pop()
        if len(calls) == call and calls:
            raise KeyboardInterrupt
        return whole(*a, **b)

    with monkeypatch.context() as m:
        m.setattr(place, step, dies)
        with pytest.raises(KeyboardInterrupt):
            update(spark, tables, rows[25:])
    # The next run gets other rows, and first ends what was begun.
    update(spark, tables, rows[:1])
    assert state(spark, tables) == full(spark, rows)
    assert not path_exists(spark, tables.stage("changes"))


def damaged(spark, tables, change):
    states = live.stored_states(spark, tables)
    run_id = pub.new_run_id()
    for name, table in states.items():
        (change(table) if name == "dim_location" else table).write.parquet(pub.run_path(tables.dimensions, run_id, name))
    pub.publish_run(spark, tables.dimensions, run_id)


def test_hours_are_tested_against_stored_dimensions(spark, path):
    """The batch brings a row of one place; the other place of that hour is missing in the dimension, or there twice."""
    tables, common = tables_at(path), {"weather_code": 1.0, "weather_description": "x"}
    update(spark, tables, [obs(place=p, observed_at=at(1, 30), **common) for p in "AB"] + [obs(place="C", observed_at=at(5), **common)])
    whole = live.stored_states(spark, tables)["dim_location"]
    for change, message in (
        (whole.where("place <> 'B'"), "relationships fact_hourly_weather.location_key: 1"),
        (whole.unionByName(whole.where("place = 'B'")), "unique dim_location.location_key: 1; unique dim_location.place: 1"),
    ):
        damaged(spark, tables, lambda _, change=change: change)
        before = state(spark, tables)
        with pytest.raises(QualityError, match=message):
            update(spark, tables, [obs(id="9", place="A", observed_at=at(1, 10), **common)])
        assert state(spark, tables) == before and not path_exists(spark, tables.stage("changes"))
    # Hours in which that place does not occur are not held up.
    assert update(spark, tables, [obs(id="9", place="C", observed_at=at(5, 0, day=29), **common)])


def test_stream(spark, path):
    rows = random_rows(60, 11)
    stream = stream_of(spark, observations(spark, *rows), path("in"), files=2, per_trigger=1)
    live.start_live(stream, tables_at(path), path("checkpoint"), SCALE).awaitTermination()
    assert state(spark, tables_at(path)) == full(spark, rows)


def test_a_stream_stops_at_a_bad_batch(spark, path):
    good, bad = (observations(spark, obs(place=p, temperature=t, weather_code=1.0, weather_description="x")) for p, t in (("A", 20.0), ("B", 99.0)))
    stream_of(spark, good, path("in"))
    reader = spark.readStream.schema(good.schema)
    live.start_live(reader.parquet(path("in")), tables_at(path), path("checkpoint")).awaitTermination()
    before = state(spark, tables_at(path))
    bad.write.mode("append").parquet(path("in"))
    with pytest.raises(Exception, match="avg_temperature_celsius: 1"):
        live.start_live(reader.parquet(path("in")), tables_at(path), path("checkpoint")).awaitTermination()
    assert state(spark, tables_at(path)) == before


def test_merge_can_be_gated(spark, path):
    from cirrolake.streaming.merge import start_merge

    def check(staged):
        if staged.where("temperature > 80").count():
            raise QualityError("too hot")

    stream = stream_of(spark, observations(spark, obs(temperature=99.0)), path("in"))
    with pytest.raises(Exception, match="too hot"):
        start_merge(stream, path("silver"), path("checkpoint"), check).awaitTermination()
    assert not path_exists(spark, path("silver"))


def test_stored_dimensions_of_nothing(spark, path):
    assert update(spark, tables_at(path), []) == []
    dims = live.read_dimensions(spark, tables_at(path))
    assert all(d.count() == 0 for d in dims.values())
    assert live.hours_of(live._silver_at(spark, tables_at(path), [])) == []
