"""The registered queries: every operator of the engine run over the given tables."""

from __future__ import annotations

import datetime as dt
import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cirrolake.functions import bins, calendar as cal
from cirrolake.functions.keys import with_observation_id
from cirrolake.operators import bronze as bz
from cirrolake.operators import dimensions as dim
from cirrolake.operators import fact, locations, profiling, quality, silver as sv
from cirrolake.plans import dashboard as dash
from cirrolake.plans import questions, stages
from cirrolake.session import configure, scratch_dir
from cirrolake.sinks import publish as pub
from cirrolake.sinks import tables as sink
from cirrolake.sources import locations as place_files
from cirrolake.sources import responses as resp
from cirrolake.sources import tables as lake_tables
from cirrolake.streaming import folding, intake, live, merge, windows
from workload import proxy

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Measures in the proxy have at most three decimals.
SCALE = 3


def _without_zone(df: DataFrame) -> DataFrame:
    """UTC instants as plain date-times, which is what the SQL side has."""
    zoned = {n for n, kind in df.dtypes if kind == "timestamp"}
    columns = {n: F.col(f"`{n}`") for n in df.columns}
    return df.select(*[c.cast("timestamp_ntz").alias(n) if n in zoned else c for n, c in columns.items()])


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _without_zone(function(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return run


def _gold(spark: SparkSession, sf_dir: str, gaps: bool = False) -> dash.Gold:
    return stages.gold_tables(proxy.silver(spark, sf_dir, gaps))


# Sources and location lists


@query
def location_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = proxy.table(spark, sf_dir, "nation")
    path = scratch_dir(spark, "locations")
    coordinates = [c.alias(n) for n, c in proxy.nation_coordinates().items()]
    sink.export_csv(nation.select(F.col("n_name").alias("name"), *coordinates), f"{path}/places")
    return place_files.read_locations(spark, f"{path}/places")


def _boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as provinces, nations as wards."""
    nation, region = proxy.table(spark, sf_dir, "nation"), proxy.table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("tỉnh "), "r_name").alias("tentinh"), F.col("n_name").alias("tenhc")
    )


@query
def boundary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "boundaries")
    sink.export_csv(_boundaries(spark, sf_dir), f"{path}/boundaries")
    read = place_files.read_boundaries(spark, f"{path}/boundaries", ["tentinh", "tenhc"])
    sink.export_csv(locations.names_within(read, "tỉnh ASIA"), f"{path}/wards")
    return place_files.read_names(spark, f"{path}/wards", "tenhc")


@query
def province_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.place_names(_boundaries(spark, sf_dir))


@query
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of customers' nations under four spellings of the prefixes."""
    raw = proxy.table(spark, sf_dir, "customer").select(
        F.concat(
            F.element_at(
                F.array(*[F.lit(p) for p in ("tỉnh ", "  TỈNH  ", "thành phố ", "THÀNH PHỐ   ")]),
                (F.col("c_custkey") % 4 + 1).cast("int"),
            ),
            F.col("c_mktsegment"),
            F.lit("  "),
        ).alias("tentinh")
    )
    return locations.place_names(raw)


@query
def geocode_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third nation has no hit, every third an unreadable one."""
    nation = proxy.table(spark, sf_dir, "nation")
    hit = F.to_json(
        F.array(
            F.struct(*[c.cast("string").alias(n[:3]) for n, c in proxy.nation_coordinates().items()]),
        )
    )
    shape = F.col("n_nationkey") % 3
    answers = nation.select(
        F.col("n_name").alias("name"),
        F.when(shape == 0, hit)
        .when(shape == 1, F.lit("[]"))
        .otherwise(F.lit('[{"lat":"north","lon":"east"}]'))
        .alias("body"),
    )
    named = locations.with_queries(nation.select(F.col("n_name").alias("name")))
    return locations.attach_coordinates(named, resp.geocoded(answers)).select("name", "query", "latitude", "longitude")


@query
def geocode_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.failed_geocodes(geocode_attach(spark, sf_dir))


# Bronze


@query
def response_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resp.current_observations(proxy.uneven_responses(spark, sf_dir))
    bronze = bz.current_to_bronze(rows, proxy.BATCH_TIME)
    p = F.from_json("raw_payload", "place_name string, ts bigint, temp double, city_name string")
    return bronze.select(p.alias("p")).select("p.*")


@query
def metadata_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resp.history_observations(proxy.history_responses(spark, sf_dir))
    o = F.col("obs")
    number = lambda key: F.try_variant_get(F.try_element_at(o, F.lit(key)), "$", "double")
    text = lambda key: F.try_variant_get(F.try_element_at(o, F.lit(key)), "$", "string")
    return rows.select(
        text("place_name").alias("place_name"),
        number("order").cast("bigint").alias("order"),
        number("line").cast("int").alias("line"),
        number("temp").alias("temp"),
        text("status").alias("status"),
        number("gust").alias("gust"),
        number("aqi").alias("aqi"),
        F.map_contains_key(o, "status").alias("has_status"),
        F.map_contains_key(o, "wind_gust_spd").alias("has_old_gust"),
        F.map_contains_key(o, "app_temp").alias("has_app_temp"),
    )


@query
def observation_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates over many magnitudes, from the values of events."""
    events = proxy.table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") / 7.0).alias("lat"),
        (F.col("value") / -1000.0).alias("lon"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
    )
    return with_observation_id(events, "weatherbit").select("event_id", "observation_id")


@query
def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds in one table; of the current feed the payload byte by byte, of both the keys that tell rows apart."""
    current = resp.classified(proxy.responses(spark, sf_dir)).drop("rejected", "reason")
    history = resp.harmonise_history(resp.current_observations(proxy.responses(spark, sf_dir)))
    both = bz.union_feeds(
        bz.current_to_bronze(current, proxy.BATCH_TIME), bz.history_to_bronze(history, proxy.BATCH_TIME)
    )
    p = F.from_json("raw_payload", "place_name string, ts bigint")
    payload = F.when(F.col("source") == bz.CURRENT_SOURCE, F.col("raw_payload"))
    return both.select(
        "observation_id", "source", "lat", "lon", "_ingested_at", "ingest_date", p["place_name"].alias("place_name"),
        p["ts"].alias("ts"), payload.alias("raw_payload"),
    )


# Silver


@query
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bz.current_to_bronze(resp.classified(proxy.responses(spark, sf_dir)), proxy.BATCH_TIME)
    return sv.observations(bronze)


@query
def silver_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bz.current_to_bronze(resp.classified(proxy.responses(spark, sf_dir)), proxy.BATCH_TIME)
    return sv.bronze_to_silver(bronze)


@query
def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds as whole text, as decimal text, and as unreadable text, which is dropped."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), seconds)).when(
        F.col("event_type") == "view", F.concat(seconds, F.lit(".0"))
    )
    raw = proxy.table(spark, sf_dir, "events").select("event_id", text.otherwise(seconds).alias("text"))
    return raw.select("event_id", cal.epoch_to_timestamp(F.col("text")).alias("observed_at")).where(
        F.col("observed_at").isNotNull()
    )


@query
def silver_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.deduplicate(proxy.observations(spark, sf_dir)).select("id", "place", "observed_at", "ingested_at")


@query
def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.silver(spark, sf_dir)


@query
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.add_features(sv.conform(proxy.observations(spark, sf_dir))).select(
        "id", "observation_hour", "day_of_week", "month"
    )


@query
def wind_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.observations(spark, sf_dir).select("id", bins.wind_category(F.col("wind_speed")).alias("wind_category"))


@query
def uv_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.observations(spark, sf_dir).select("id", bins.uv_category(F.col("uv_index")).alias("uv_category"))


@query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the refresh of Silver says of itself: rows read, rows written, and their difference."""
    landing, lake = _land(spark, proxy.responses(spark, sf_dir), "counts")
    stages.ingest_current(spark, landing, lake, proxy.BATCH_TIME)
    run = stages.refresh_silver(spark, lake)
    return spark.range(1).select(
        *[F.lit(getattr(run, name)).cast("bigint").alias(name) for name in ("rows_read", "rows_written", "rows_removed")]
    )


# Gold


@query
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.dim_location(proxy.silver(spark, sf_dir))


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.dim_date(proxy.silver(spark, sf_dir))


@query
def dim_date_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.dim_date(proxy.table(spark, sf_dir, "orders"), "o_orderdate")


@query
def dim_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.dim_weather(proxy.silver(spark, sf_dir, gaps=True))


@query
def fact_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = proxy.silver(spark, sf_dir, gaps=True)
    return fact.fact_hourly_weather(s, dim.dim_location(s), dim.dim_date(s), dim.dim_weather(s))


@query
def fact_hourly_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.fact_from_same_silver(proxy.silver(spark, sf_dir, gaps=True))


@query
def fact_at_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = proxy.items_as_observations(spark, sf_dir)
    return fact.fact_hourly_weather(s, dim.dim_location(s), dim.dim_date(s), dim.dim_weather(s), scale=2)


# Dashboard


@query
def kpi_total_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.total_locations(_gold(spark, sf_dir))


@query
def kpi_average_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.average_temperature(_gold(spark, sf_dir), scale=SCALE)


@query
def kpi_average_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.average_humidity(_gold(spark, sf_dir), scale=SCALE)


@query
def kpi_average_cloud_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.average_cloud_coverage(_gold(spark, sf_dir), scale=SCALE)


@query
def kpi_highest_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.highest_wind(_gold(spark, sf_dir))


FILTER_DATES = (dt.date(2024, 1, 8), dt.date(2024, 1, 14))
FILTER_PLACES = ["NATION_3", "NATION_7", "NATION_11"]


@query
def kpi_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.average_temperature(_gold(spark, sf_dir), FILTER_DATES, FILTER_PLACES, scale=SCALE)


@query
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.daily_trend(_gold(spark, sf_dir), scale=SCALE)


@query
def location_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.location_map(_gold(spark, sf_dir))


@query
def top5_highest_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.highest_temperature(_gold(spark, sf_dir), scale=SCALE)


@query
def bottom5_lowest_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.lowest_temperature(_gold(spark, sf_dir), scale=SCALE)


@query
def top5_most_humid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.most_humid(_gold(spark, sf_dir), scale=SCALE)


@query
def bottom5_least_humid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.least_humid(_gold(spark, sf_dir), scale=SCALE)


@query
def top5_strongest_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.strongest_wind(_gold(spark, sf_dir))


@query
def bottom5_weakest_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.weakest_wind(_gold(spark, sf_dir))


@query
def weather_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.weather_distribution(_gold(spark, sf_dir))


@query
def detail_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.detail_table(_gold(spark, sf_dir, gaps=True))


@query
def detail_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.detail_table(_gold(spark, sf_dir), FILTER_DATES, FILTER_PLACES)


@query
def detail_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table of a written star schema, of which only the newest dates are read."""
    lake = stages.Lake(scratch_dir(spark, "detail"))
    sink.write_silver(proxy.silver(spark, sf_dir, gaps=True), f"{lake.silver}/candidate")
    silver = lake_tables.read_silver(spark, f"{lake.silver}/candidate")
    return dash.detail_table(stages.write_gold(silver, lake, pub.new_run_id()), stored=True)


# Questions


@query
def last_24h_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.recent_trend(proxy.silver(spark, sf_dir), 24, "hour", scale=SCALE)


@query
def last_7d_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.recent_trend(proxy.silver(spark, sf_dir), 7 * 24, "day", scale=SCALE)


@query
def last_24h_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a written Silver table, of which only the last dates are read."""
    path = f"{scratch_dir(spark, 'recent')}/silver"
    sink.write_silver(proxy.silver(spark, sf_dir), path)
    silver = lake_tables.read_silver(spark, path, keep_date=True)
    return questions.recent_trend(silver, 24, "hour", scale=SCALE, partition=lake_tables.SILVER_PARTITION)


@query
def vs_7day_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.against_past_week(proxy.silver(spark, sf_dir), scale=SCALE)


@query
def current_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.current_extremes(proxy.silver(spark, sf_dir))


@query
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = proxy.table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return questions.coverage(proxy.silver(spark, sf_dir), places)


@query
def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = proxy.table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return questions.missing_hours(proxy.silver(spark, sf_dir), places)


@query
def condition_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.condition_frequency(_gold(spark, sf_dir))


# Data tests


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failing_rows(
        quality.Unique("orders", "o_custkey"), {"orders": proxy.table(spark, sf_dir, "orders")}
    )


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = proxy.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus")
    )
    return quality.failing_rows(quality.NotNull("orders", "o_orderstatus"), {"orders": orders})


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against the customers outside one market segment."""
    customers = proxy.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    orders = proxy.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    test = quality.Relationship("orders", "o_custkey", "customer", "c_custkey")
    return quality.failing_rows(test, {"orders": orders, "customer": customers})


@query
def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = proxy.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return quality.failing_rows(quality.AcceptedRange("lineitem", "l_quantity", 2, 45), {"lineitem": items})


@query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tests of the star schema, whose weather has gaps here. They read it many times, so it is written first."""
    lake = stages.Lake(scratch_dir(spark, "tests"))
    sink.write_silver(proxy.silver(spark, sf_dir, gaps=True), f"{lake.silver}/candidate")
    silver = lake_tables.read_silver(spark, f"{lake.silver}/candidate")
    return quality.run_tests(vars(stages.write_gold(silver, lake, pub.new_run_id())))


# Profiles


@query
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.distinct_counts(proxy.table(spark, sf_dir, "lineitem"))


@query
def profile_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.column_info(proxy.silver(spark, sf_dir))


@query
def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.describe(proxy.observations(spark, sf_dir), "wind_speed", scale=SCALE)


@query
def profile_describe_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.exact_percentiles(
        proxy.table(spark, sf_dir, "lineitem"), "l_extendedprice", (0.25, 0.5, 0.75)
    ).select(*[F.col("percentiles")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))])


@query
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.preview(proxy.observations(spark, sf_dir).select("id", "place", "observed_at"), "observed_at", "id")


# Sinks and whole runs


@query
def roundtrip_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'silver')}/silver"
    sink.write_silver(proxy.silver(spark, sf_dir), path)
    return lake_tables.stage_silver(lake_tables.read_silver(spark, path))


@query
def silver_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partitions of a written Silver table."""
    path = f"{scratch_dir(spark, 'silver')}/silver"
    sink.write_silver(proxy.silver(spark, sf_dir), path)
    return lake_tables.read_silver(spark, path, list(FILTER_DATES)).select("id", "place", "observed_at")


@query
def schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to Bronze, the second with one more envelope column."""
    path = f"{scratch_dir(spark, 'bronze')}/bronze"
    rows = resp.current_observations(proxy.responses(spark, sf_dir))
    sink.append_bronze(bz.current_to_bronze(rows, proxy.BATCH_TIME), path)
    later = bz.history_to_bronze(rows, proxy.BATCH_TIME + dt.timedelta(days=1))
    sink.append_bronze(later.withColumn("station", F.get_json_object("raw_payload", "$.city_name")), path)
    return lake_tables.read_bronze(spark, path, merge=True).select("observation_id", "source", "station", "ingest_date")


def _land(spark: SparkSession, docs: DataFrame, label: str) -> tuple[str, stages.Lake]:
    """Write documents as landed files of one document per line."""
    root = scratch_dir(spark, label)
    docs.select("body").write.text(f"{root}/landing")
    return f"{root}/landing", stages.Lake(f"{root}/lake")


@query
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every unit of dirty documents went: rejected by stage and reason, written, or dropped as a duplicate."""
    landing, lake = _land(spark, proxy.dirty_responses(spark, sf_dir), "dirty")
    accepted = stages.ingest_current(spark, landing, lake, proxy.BATCH_TIME)
    run = stages.refresh_silver(spark, lake)
    found = stages.rejects(spark, lake).groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n"))
    assert accepted == run.rows_read == run.rows_written + run.rows_rejected + run.duplicates
    rest = [("bronze", "accepted", accepted), ("silver", "accepted", run.rows_written), ("silver", "duplicate", run.duplicates)]
    return found.unionByName(spark.createDataFrame(rest, found.schema))


@query
def silver_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver that dirty documents leave."""
    landing, lake = _land(spark, proxy.dirty_responses(spark, sf_dir), "dirty")
    stages.ingest_current(spark, landing, lake, proxy.BATCH_TIME)
    stages.build_silver(spark, lake)
    return stages.current_silver(spark, lake)


@query
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, lake = _land(spark, proxy.responses(spark, sf_dir), "run")
    return stages.run_all(spark, landing, lake, proxy.BATCH_TIME).fact_hourly_weather


@query
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, lake = _land(spark, proxy.responses(spark, sf_dir), "backfill")
    stages.backfill(spark, landing, lake, proxy.BATCH_TIME, *FILTER_DATES)
    return lake_tables.read_bronze(spark, lake.bronze).select("observation_id", "source", "lat", "lon", "ingest_date")


@query
def publish_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good version is published; a second one fails its tests; readers still have the first."""
    lake = stages.Lake(scratch_dir(spark, "publish"))

    def silver_version(gaps: bool) -> None:
        run_id = pub.new_run_id()
        sink.write_silver(proxy.silver(spark, sf_dir, gaps), pub.run_path(lake.silver, run_id))
        pub.publish_run(spark, lake.silver, run_id)

    silver_version(gaps=False)
    stages.build_gold(spark, lake)
    silver_version(gaps=True)
    try:
        stages.build_gold(spark, lake)
    except quality.QualityError:
        return stages.read_gold(spark, lake).fact_hourly_weather
    raise AssertionError("a star schema with gaps was published")


# Streams


@query
def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, lake = _land(spark, proxy.responses(spark, sf_dir), "intake")
    started = intake.start_intake(
        spark, landing, lake.bronze, f"{lake.root}/checkpoint", ingested_at=proxy.BATCH_TIME
    )
    started.awaitTermination()
    return lake_tables.read_bronze(spark, lake.bronze).select(
        "observation_id", "source", "lat", "lon", "ingest_date"
    )


def _in_batches(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Observations as a stream of four batches, from landed files of no order: most rows are late."""
    obs = proxy.observations(spark, sf_dir)
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    obs.repartition(files).write.parquet(f"{root}/landed")
    return spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", math.ceil(files / 4)).parquet(f"{root}/landed")


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest observation of each place and hour; the table is closed after the third batch, the fourth is late."""
    root, state = scratch_dir(spark, "first"), windows.first_rows()
    stream = _in_batches(spark, sf_dir, root)
    folding.start_folding(stream, state, f"{root}/state", f"{root}/checkpoint", close_every=3).awaitTermination()
    return folding.current(state, spark, f"{root}/state")


@query
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours with all their rows; closed after two batches, and the other two fall into closed hours."""
    root, state = scratch_dir(spark, "hourly"), windows.hourly_measures(SCALE)
    stream = _in_batches(spark, sf_dir, root)
    folding.start_folding(stream, state, f"{root}/state", f"{root}/checkpoint", close_every=2).awaitTermination()
    return windows.hourly_result(folding.current(state, spark, f"{root}/state"))


@query
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations landed in files of no order and merged in four batches."""
    root = scratch_dir(spark, "merge")
    stream = _in_batches(spark, sf_dir, root)
    merge.start_merge(stream, f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    return lake_tables.read_silver(spark, f"{root}/silver")


@query
def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests on two days; after each, only its own raw partition is parsed and only its dates are rewritten."""
    docs = proxy.responses(spark, sf_dir)
    first = F.get_json_object("body", "$.data[0].ts").cast("bigint") < F.unix_timestamp(F.lit("2024-01-16 12:00:00"))
    root = scratch_dir(spark, "update")
    lake = stages.Lake(f"{root}/lake", live_by_hour=False)
    for n, part in enumerate((docs.where(~first), docs.where(first))):
        part.select("body").write.text(f"{root}/landing{n}")
        ingested_at = proxy.BATCH_TIME + dt.timedelta(days=n)
        stages.ingest_current(spark, f"{root}/landing{n}", lake, ingested_at)
        stages.update_live(spark, lake, since=ingested_at.date())
    return stages.read_live(spark, lake).fact_hourly_weather


@query
def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table whose second half of dates is refreshed after a merge."""
    root = scratch_dir(spark, "fact")
    obs = proxy.observations(spark, sf_dir)
    early = F.col("observed_at") < F.lit(dt.datetime(2024, 1, 16))
    for n, part in enumerate((obs.where(early), obs.where(~early))):
        dates = merge.merge_silver(part, f"{root}/silver", f"{root}/stage/silver={n}")
        merge.refresh_fact(spark, f"{root}/silver", f"{root}/fact", f"{root}/stage/fact={n}", dates)
    return merge.read_fact(spark, f"{root}/fact")




@query
def run_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two whole runs over one landing folder: each landed file is in Bronze once."""
    landing, lake = _land(spark, proxy.responses(spark, sf_dir), "twice")
    stages.run_all(spark, landing, lake, proxy.BATCH_TIME)
    stages.run_all(spark, landing, lake, proxy.BATCH_TIME)
    return lake_tables.read_bronze(spark, lake.bronze).select("observation_id", "source", "lat", "lon", "ingest_date")


@query
def stream_two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as streams and then a batch backfill, each of them twice, into one Bronze table."""
    landing, lake = _land(spark, proxy.responses(spark, sf_dir), "feeds")
    for feed in ("current", "history", "current", "history"):
        started = intake.start_intake(
            spark, landing, lake.bronze, f"{lake.root}/checkpoints/{feed}", feed, proxy.BATCH_TIME
        )
        started.awaitTermination()
    for _ in range(2):
        stages.backfill(spark, landing, lake, proxy.BATCH_TIME, *FILTER_DATES)
    return lake_tables.read_bronze(spark, lake.bronze).select("observation_id", "source", "lat", "lon", "ingest_date")


@query
def live_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live tables after four streamed batches of no order, whose change rows retract what earlier batches put in.

    The fact with the attributes of its place, and beside them the number of stored dates and weathers.
    """
    root = scratch_dir(spark, "stream")
    tables = live.LiveTables(f"{root}/live", by_hour=False)
    live.start_live(_in_batches(spark, sf_dir, root), tables, f"{root}/checkpoint", SCALE).awaitTermination()
    dims = live.read_dimensions(spark, tables)
    fact = lake_tables.read_gold_table(spark, tables.fact, "fact_hourly_weather").join(dims["dim_location"], "location_key", "left")
    counts = [dims[name].agg(F.count(F.lit(1)).alias(f"n_{name}")) for name in ("dim_date", "dim_weather")]
    return functools.reduce(lambda left, right: left.crossJoin(F.broadcast(right)), counts, fact)


def _store(spark: SparkSession, tables: live.LiveTables, change: Callable[[DataFrame], DataFrame]) -> None:
    """Publish stored dimensions with another table of places."""
    states = live.stored_states(spark, tables)
    run_id = pub.new_run_id()
    for name, state in states.items():
        (change(state) if name == "dim_location" else state).write.parquet(pub.run_path(tables.dimensions, run_id, name))
    pub.publish_run(spark, tables.dimensions, run_id)


@query
def live_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good batch, and then three that the gate must refuse; the live tables stay as they were.

    One is too hot. One meets stored dimensions that have lost places, so references break in the hours it touches. One
    meets dimensions that hold each place twice, so unique tests break.
    """
    docs = proxy.responses(spark, sf_dir)
    early = F.get_json_object("body", "$.data[0].ts").cast("bigint") < F.unix_timestamp(F.lit("2024-01-16 12:00:00"))
    body = F.col("body")
    root = scratch_dir(spark, "gate")
    lake = stages.Lake(f"{root}/lake", live_by_hour=False)
    tables = stages.live_tables(lake)
    # An earlier second of an hour that the live tables have already: the hour is touched, and its other places are met.
    again = docs.where(early).withColumn("body", F.regexp_replace(body, '"ts":\\d+', F.concat(F.lit('"ts":'), _hour_start(body))))
    steps = [
        (docs.where(early), None, None),
        (docs.where(~early).withColumn("body", F.regexp_replace(body, '"temp":[^,]*', '"temp":99.0')), None, "accepted_range"),
        (again.where(F.col("place_name") == "NATION_3"), lambda s: s.where("place = 'NATION_3'"), "relationships"),
        (again.where(F.col("place_name") == "NATION_3"), lambda s: s.unionByName(s), "unique"),
    ]
    for n, (part, damage, failing) in enumerate(steps):
        part.select("body").write.text(f"{root}/landing{n}")
        ingested_at = proxy.BATCH_TIME + dt.timedelta(days=n)
        stages.ingest_current(spark, f"{root}/landing{n}", lake, ingested_at)
        if damage:
            whole = live.stored_states(spark, tables)["dim_location"]
            _store(spark, tables, damage)
        try:
            stages.update_live(spark, lake, since=ingested_at.date())
        except quality.QualityError as error:
            if failing is None or failing not in str(error):
                raise
        else:
            assert failing is None, f"no {failing} test failed"
        if damage:
            _store(spark, tables, lambda _: whole)
    return stages.read_live(spark, lake).fact_hourly_weather


def _hour_start(body: Column) -> Column:
    """The first second of the hour of a document's first observation, as text."""
    seconds = F.get_json_object(body, "$.data[0].ts").cast("bigint")
    return (seconds - seconds % 3600).cast("string")
