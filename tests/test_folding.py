"""Streams folded into tables: nothing lost, nothing counted twice, whichever step a run dies in."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from builders import at, obs, observations, values
from cirrolake.operators.silver import deduplicate
from cirrolake.sinks.merge import path_exists
from cirrolake.streaming import folding, windows
from test_streaming import random_rows, stream_of

SCALE = 1


def whole(spark, rows):
    """The batch reckoning of both tables."""
    df = observations(spark, *rows)
    hourly = windows.hourly_measures(SCALE)
    return values(windows.hourly_result(hourly.partial(df))), values(deduplicate(df))


def both(spark, root):
    states = windows.hourly_measures(SCALE), windows.first_rows()
    hours, rows = (folding.current(s, spark, f"{root}/{n}") for n, s in enumerate(states))
    return values(windows.hourly_result(hours)), values(rows)


def add(spark, root, number, rows):
    for n, state in enumerate((windows.hourly_measures(SCALE), windows.first_rows())):
        folding.add_batch(state, observations(spark, *rows), f"{root}/{n}", number)


def close(spark, root):
    return [folding.close(s, spark, f"{root}/{n}") for n, s in enumerate((windows.hourly_measures(SCALE), windows.first_rows()))]


def test_late_rows_fold_into_closed_hours(spark, path):
    rows = [*random_rows(120), obs(place=None), obs(observed_at=None), obs(id="x", weather_code=None)]
    for number, part in enumerate((rows[80:], rows[40:80], rows[:40])):
        add(spark, path("s"), number, part)
        if number == 1:
            assert [len(d) for d in close(spark, path("s"))] == [3, 3]
    # The third batch falls into hours that are closed; readers see it before and after the next closing.
    assert both(spark, path("s")) == whole(spark, rows)
    close(spark, path("s"))
    assert both(spark, path("s")) == whole(spark, rows)
    assert [close(spark, path("s")), folding.folders(spark, path("s") + "/0/deltas")] == [[[], []], []]


def test_a_batch_that_runs_again_replaces_itself(spark, path):
    rows = random_rows(60)
    add(spark, path("s"), 0, rows[:30])
    add(spark, path("s"), 1, rows[:10])
    add(spark, path("s"), 1, rows[30:])
    assert both(spark, path("s")) == whole(spark, rows)
    close(spark, path("s"))
    # The stream died after the closing and before it noted the batch: the batch comes again.
    add(spark, path("s"), 1, rows[30:])
    assert both(spark, path("s")) == whole(spark, rows)
    assert close(spark, path("s")) == [[], []]
    assert both(spark, path("s")) == whole(spark, rows)


def test_deltas_that_outlived_their_closing_do_not_count_again(spark, path):
    rows = random_rows(60)
    add(spark, path("s"), 0, rows[:30])
    close(spark, path("s"))
    add(spark, path("s"), 1, rows[30:])
    shutil.copytree(path("s") + "/0/deltas", path("kept"))
    close(spark, path("s"))
    shutil.copytree(path("kept"), path("s") + "/0/deltas", dirs_exist_ok=True)
    assert both(spark, path("s")) == whole(spark, rows)
    close(spark, path("s"))
    assert both(spark, path("s")) == whole(spark, rows)


def test_an_interrupted_closing_is_finished(spark, path, monkeypatch):
    """The stage is whole, and the base has lost one of its dates."""
    rows = random_rows(60)
    add(spark, path("s"), 0, rows[:30])
    close(spark, path("s"))
    add(spark, path("s"), 1, rows[30:])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("cirrolake.sinks.merge.finish_replacement", die)
        with pytest.raises(RuntimeError):
            folding.close(windows.hourly_measures(SCALE), spark, path("s") + "/0")
    base = path("s") + "/0/base"
    shutil.rmtree(f"{base}/{sorted(d for d in os.listdir(base) if '=' in d)[0]}")
    close(spark, path("s"))
    assert not path_exists(spark, path("s") + "/0/stage")
    assert both(spark, path("s")) == whole(spark, rows)


def test_unfinished_deltas_are_not_read(spark, path):
    add(spark, path("s"), 0, random_rows(20))
    os.makedirs(path("s") + "/0/deltas/batch=1/fold_date=2025-10-29")
    assert both(spark, path("s")) == whole(spark, random_rows(20))


def test_nothing_yet(spark, path):
    assert both(spark, path("s")) == ([], []) and close(spark, path("s")) == [[], []]
    add(spark, path("s"), 0, [obs(place=None)])
    assert both(spark, path("s")) == ([], []) and close(spark, path("s")) == [[], []]


def test_a_stream_in_batches(spark, path):
    rows = random_rows(200)
    stream = stream_of(spark, observations(spark, *rows), path("in"), files=5, per_trigger=1)
    state = windows.first_rows()
    folding.start_folding(stream, state, path("s"), path("checkpoint"), close_every=2).awaitTermination()
    assert folding.folders(spark, path("s") + "/deltas") == ["batch=4"]
    assert values(folding.current(state, spark, path("s"))) == whole(spark, rows)[1]


def test_closing_rewrites_touched_dates_only(spark, path):
    state = windows.first_rows()
    days = [observations(spark, obs(id=str(d), observed_at=at(1, 30, day=d))) for d in (27, 28, 29)]
    folding.add_batch(state, days[0].union(days[1]), path("s"), 0)
    folding.close(state, spark, path("s"))
    before = {d: sorted(os.listdir(f"{path('s')}/base/{d}")) for d in os.listdir(path("s") + "/base") if "=" in d}
    folding.add_batch(state, days[2], path("s"), 1)
    assert [d.day for d in folding.close(state, spark, path("s"))] == [29]
    assert {d: sorted(os.listdir(f"{path('s')}/base/{d}")) for d in before} == before


def test_copies_of_a_hot_key_leave_each_task_as_one_row(spark):
    rows = observations(spark, *random_rows(20))
    plan = windows.first_rows().partial(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit") and "Partial" in plan
    hourly = windows.hourly_measures().partial(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in hourly and "partial_max" in hourly


def test_sums_without_scale(spark):
    rows = observations(spark, *random_rows(50))
    state = windows.hourly_measures()
    parts = rows.repartition(3, "id")
    one = state.merge(state.partial(parts.where("id % 2 = 0")).unionByName(state.partial(parts.where("id % 2 = 1"))))
    assert one.schema.names == state.schema.names and [f.dataType for f in one.schema] == [f.dataType for f in state.schema]
    expected = windows.hourly_result(state.partial(rows)).agg(F.sum("avg_temperature_celsius"), F.sum("observation_count")).first()
    got = windows.hourly_result(one).agg(F.sum("avg_temperature_celsius"), F.sum("observation_count")).first()
    assert got[0] == pytest.approx(expected[0]) and got[1] == expected[1] == 50
