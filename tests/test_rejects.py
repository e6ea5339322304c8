"""What is landed is written, rejected with a reason, or a duplicate: nothing vanishes uncounted."""

import json

import pytest

from builders import NOON, at, bronze, responses, values
from cirrolake.operators import silver as sv
from cirrolake.operators.bronze import current_to_bronze, history_to_bronze
from cirrolake.plans import stages
from cirrolake.sinks import publish as pub
from cirrolake.sinks import tables as sink
from cirrolake.sources import responses as resp
from cirrolake.sources import tables as src
from test_stages import body, land

GOOD = {"ts": 5, "lat": 1.5, "temp": 2}
BODIES = [
    {"place_name": "A", "data": [GOOD, 5, None, "x", [1], {}]},
    "broken {",
    "",
    "[1, 2]",
    "null",
    '"text"',
    {"place_name": "B", "data": "busy"},
    {"place_name": "B", "data": {"ts": 1}},
    {"place_name": "C"},
    {"place_name": "C", "data": []},
    {"place_name": "C", "data": None},
    {"data": [GOOD]},
]


@pytest.mark.parametrize("feed", ["current", "history"])
def test_every_unit_is_one_or_the_other(spark, feed):
    found = resp.classified(responses(spark, *BODIES), feed)
    assert values(found.where("reason is not null"), "reason", "rejected") == sorted([
        *[("element_not_object", e) for e in ("5", "null", '"x"', "[1]")],
        *[("body_not_json", b) for b in ("broken {", "")],
        *[("body_not_object", b) for b in ("[1, 2]", "null", '"text"')],
        *[("data_not_array", json.dumps(b)) for b in BODIES[6:8]],
    ])
    assert found.where("reason is null").count() == 3


@pytest.mark.parametrize(("feed", "plain", "wrap"), [
    ("current", resp.current_observations, current_to_bronze), ("history", resp.history_observations, history_to_bronze),
])
def test_accepted_ones_are_the_plain_observations(spark, feed, plain, wrap):
    docs = [{"place_name": "A", "zone": 7, "lat": 9, "data": [GOOD | {"wind_gust_spd": 3}, {"ts": 6, "zone": None, "gust": 1}]}, *BODIES[:1], BODIES[-1]]
    landed = responses(spark, *docs)
    accepted = wrap(resp.classified(landed, feed), NOON).where("reason is null").drop("reason")
    parsed = lambda df: sorted((r.observation_id or "", r.lat or 0, json.dumps(json.loads(r.raw_payload), sort_keys=True)) for r in df.collect())
    assert parsed(accepted) == parsed(wrap(plain(landed), NOON))


def test_payload_as_it_came(spark):
    """Keys stay in their order and floats stay floats; the place name stands at the end, or where one was."""
    elements = [
        '{"z":21.0,"lat":1.0,"ts":5,"a":1.5,"text":"é \\"q\\" {","none":null,"big":12345678901234567890,"w":{"y":[1,2.0],"x":{}}}',
        "{}",
        '{"ts":5,"place_name":"theirs"}',
        '{"ts":"5"}',
    ]
    landed = responses(spark, *['{"place_name":"Hà \\"N\\"","data":[%s]}' % e for e in elements], '{"data":[{"ts":1.0}]}')
    got = [r.raw_payload for r in current_to_bronze(resp.classified(landed), NOON).collect()]
    name = '"place_name":"Hà \\"N\\""'
    assert got == [
        elements[0][:-1] + f",{name}}}", f"{{{name}}}", f'{{"ts":5,{name}}}', f'{{"ts":"5",{name}}}', '{"ts":1.0,"place_name":null}'
    ]


def test_strings_that_look_like_objects_are_none(spark):
    landed = responses(spark, '{"place_name":"A","data":["{\\"ts\\":1}", {"ts":2}, " {"]}')
    found = resp.classified(landed)
    assert values(found, "payload", "rejected") == sorted(
        [('{"ts":2,"place_name":"A"}', None), (None, '"{\\"ts\\":1}"'), (None, '" {"')], key=repr
    )


def test_bronze_keeps_rejects_apart(spark, path):
    rows = current_to_bronze(resp.classified(responses(spark, *BODIES)), NOON)
    assert sink.append_bronze(rows, path("bronze"), "one") == 3
    assert src.read_bronze(spark, path("bronze")).count() == src.read_bronze(spark, path("bronze"), since=NOON.date()).count() == 3
    assert src.read_bronze(spark, path("bronze"), merge=True).count() == 3
    rejected = src.read_rejected_bronze(spark, path("bronze"))
    assert rejected.count() == 11 and values(rejected, "ingested_at")[0] == (NOON.replace(tzinfo=None),)
    # Batches without any reason, as others append them, lie beside.
    assert sink.append_bronze(src.read_bronze(spark, path("bronze")), path("bronze"), "two") == 3
    assert src.read_bronze(spark, path("bronze")).count() == 6 and src.read_rejected_bronze(spark, path("bronze")).count() == 11


def test_reasons_of_silver(spark):
    rows = bronze(
        spark, {"place_name": "A", "ts": 5}, {"place_name": "A", "ts": 6}, "broken {", None, {"ts": 5}, {"place_name": "A"},
        {"place_name": "A", "ts": "never"}, {"place_name": "A", "ts": 1e12}, {"place_name": None, "ts": None}, {"place_name": "A", "ts": "7", "temp": "x"},
    )
    found = sv.bronze_to_silver_and_rejects(rows)
    reasons = [r for r, in values(found, "reason") if r]
    assert sorted(reasons) == ["no_place"] * 2 + ["payload_not_json"] * 2 + ["unreadable_time"] * 3
    assert values(found.where("reason is null").drop("reason", "raw_payload")) == values(sv.bronze_to_silver(rows))
    assert found.where("reason is not null and raw_payload is null").count() == 1


def test_a_run_accounts_for_everything(spark, path):
    lake = stages.Lake(path("lake"))
    land(path("landing"), body("A", 1, 1, 2), {"place_name": "A", "data": [{"ts": "never"}, 7]}, [3])
    assert stages.ingest_current(spark, path("landing"), lake, NOON) == 4
    run = stages.refresh_silver(spark, lake)
    assert (run.rows_read, run.rows_written, run.rows_rejected, run.duplicates) == (4, 2, 1, 1)
    assert stages.current_silver(spark, lake).count() == 2
    found = stages.rejects(spark, lake)
    assert values(found, "stage", "reason") == [("bronze", "body_not_object"), ("bronze", "element_not_object"), ("silver", "unreadable_time")]


def test_rejects_of_an_unpublished_version(spark, path):
    lake = stages.Lake(path("lake"))
    land(path("landing"), {"place_name": "A", "data": [{"ts": "never"}]})
    stages.ingest_current(spark, path("landing"), lake, NOON)
    run = stages.refresh_silver(spark, lake)
    assert run.run_id is None and run.rows_rejected == 1
    assert values(stages.rejects(spark, lake, run.attempt), "reason") == [("unreadable_time",)]


def test_history_rejects_whatever_the_range(spark, path):
    lake = stages.Lake(path("lake"))
    data = [{"ts": int(at(1, day=d).timestamp())} for d in (28, 29)]
    land(path("landing"), {"place_name": "A", "data": [*data, "x"]}, "{}")
    assert stages.backfill(spark, path("landing"), lake, NOON, at(0, day=29).date(), at(0, day=29).date()) == 1
    assert values(src.read_rejected_bronze(spark, lake.bronze), "source", "reason") == [
        ("weatherbit_historical", "body_not_object"), ("weatherbit_historical", "element_not_object")
    ]


def test_many_rejects_are_no_hot_key(spark, path):
    """Rejected rows share neither place nor hour, yet none of them is lost and none waits for another."""
    rows = bronze(spark, *[{"place_name": None, "ts": None} for _ in range(200)])
    found = sv.bronze_to_silver_and_rejects(rows.repartition(4))
    assert sink.write_silver_and_rejects(found, path("silver")) == (0, 200)
    assert "_own" in found._jdf.queryExecution().optimizedPlan().toString()
    assert src.read_silver(spark, path("silver")).count() == 0


def test_one_scan_gives_both(spark, path):
    sink.append_bronze(bronze(spark, {"place_name": "A", "ts": 5}, "broken {"), path("bronze"), "b")
    plan = sv.bronze_to_silver_and_rejects(src.read_bronze(spark, path("bronze")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1 and plan.count("from_json") == 1


def test_sound_documents_are_parsed_once(spark, path):
    landed = responses(spark, *BODIES)
    landed.select("body").write.text(path("landing"))
    plan = resp.classified(resp.read_responses(spark, path("landing")))._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and "CASE WHEN doubtful" in plan


def test_published_versions_are_dropped_by_age(spark, path):
    import datetime as dt

    ids = [pub.new_run_id(NOON + dt.timedelta(days=d)) for d in range(4)]
    for run_id in ids:
        spark.range(1).write.parquet(pub.run_path(path("v"), run_id))
        pub.publish_run(spark, path("v"), run_id)
    spark.range(1).write.parquet(pub.run_path(path("v"), "unpublished"))
    assert pub.drop_versions(spark, path("v"), 1, older_than=dt.timedelta(hours=1)) == []
    assert pub.drop_versions(spark, path("v"), 2) == ids[1::-1]
    assert spark.read.parquet(pub.run_path(path("v"), ids[3])).count() == spark.read.parquet(pub.run_path(path("v"), "unpublished")).count() == 1
