"""Gold that is kept up to date by change rows.

New observations are laid beside the live Silver of their hours. Where one takes the place of another, or of none, that
is a change: the row that comes in, and the one that goes. Only changes travel further. Silver and the fact lie in a
folder for each hour, and an update rewrites the hours in which something changed; where hours are thin they lie in one
for each date, and the date's other groups are copied. The dimensions are stored tables of one row for each key, to which
changes are applied. The result is what a full run over everything would give.

An update is staged whole, tested against the stored dimensions, and then put in place:
  changes -> new hours of Silver and fact, new dimensions -> tests -> hours replaced -> dimensions published.
Each step gives the same when it is done again, so a run that died is taken up from its staged changes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cirrolake.functions.calendar import hour_bucket
from cirrolake.operators.dimensions import LOCATION_ROW, keyed_dates, keyed_locations, keyed_weathers, latest_rows, location_key
from cirrolake.operators.fact import fact_from_same_silver
from cirrolake.operators.quality import gate
from cirrolake.operators.silver import add_features, deduplicate, survivor_order
from cirrolake.schemas import DATE, GOLD, LONG, OBSERVATION_COLUMNS, SILVER, STRING
from cirrolake.sinks import publish as pub
from cirrolake.sinks.merge import finish_replacement, path_exists, remove, staged
from cirrolake.sources.tables import FACT_PARTITION, SILVER_PARTITION, read_gold_table, read_silver

SILVER_HOURS = [SILVER_PARTITION, "observation_hour"]
FACT_HOURS = [FACT_PARTITION, "observation_hour"]
SILVER_SCHEMA = T.StructType([*SILVER.fields, T.StructField(SILVER_PARTITION, DATE)])
CHANGE_SCHEMA = T.StructType([*SILVER_SCHEMA.fields, T.StructField("op", STRING), T.StructField("change", STRING)])
INSERT, RETRACT = "insert", "retract"

#: More dates than these are read whole instead of hour by hour, to keep the filter short.
DATES_BY_HOUR = 62
#: Versions of the dimensions that stay for readers who hold them.
KEPT_VERSIONS = 3

# What the stored dimensions hold: of a place its latest row, of a weather its number of rows in Silver.
STATES = {
    "dim_location": T.StructType([SILVER[c] for c in LOCATION_ROW]),
    "dim_date": T.StructType([T.StructField("full_date", DATE)]),
    "dim_weather": T.StructType([SILVER["weather_code"], SILVER["weather_description"], T.StructField("n", LONG)]),
}

Hours = list[tuple[dt.date, int]]


@dataclass(frozen=True)
class LiveTables:
    """The folders of the live tables, one for each hour or, without `by_hour`, for each date. It stays as it was chosen."""

    root: str
    by_hour: bool = True

    @property
    def silver_parts(self) -> list[str]:
        return SILVER_HOURS if self.by_hour else [SILVER_PARTITION]

    @property
    def fact_parts(self) -> list[str]:
        return FACT_HOURS if self.by_hour else [FACT_PARTITION]

    @property
    def silver(self) -> str:
        return f"{self.root}/weather_observations"

    @property
    def fact(self) -> str:
        return f"{self.root}/fact_hourly_weather"

    @property
    def dimensions(self) -> str:
        return f"{self.root}/dimensions"

    def stage(self, name: str) -> str:
        return f"{self.root}/stages/{name}"


def hours_of(rows: DataFrame) -> Hours:
    """The calendar hours of rows, at most 24 a day."""
    return sorted(map(tuple, rows.select(*SILVER_HOURS).distinct().collect()))


def _within(hours: Hours, live: LiveTables, date: str) -> Column:
    """A filter on the folders of Silver or the fact that hold these hours."""
    of_date: dict[dt.date, list[int]] = {}
    for day, hour in hours:
        of_date.setdefault(day, []).append(hour)
    value = lambda day: F.lit(int(f"{day:%Y%m%d}") if date == FACT_PARTITION else day)
    if not live.by_hour or len(of_date) > DATES_BY_HOUR:
        return F.col(date).isin([value(day) for day in of_date])
    parts = [(F.col(date) == value(day)) & F.col("observation_hour").isin(of_date[day]) for day in of_date]
    return reduce(or_, parts, F.lit(False))


def _silver_at(spark: SparkSession, live: LiveTables, hours: Hours) -> DataFrame:
    if not path_exists(spark, live.silver):
        return spark.createDataFrame([], SILVER_SCHEMA)
    return read_silver(spark, live.silver, keep_date=True).where(_within(hours, live, SILVER_PARTITION))


def changes_between(old: DataFrame, new: DataFrame) -> DataFrame:
    """Silver rows with `op`: those that come in and those that go when `new` observations meet `old` ones.

    Both have one row for a place and hour at most. A new row that is there already, or does not survive, is no change.
    """
    both = old.select(*OBSERVATION_COLUMNS, F.lit(0).alias("_new")).unionByName(
        new.select(*OBSERVATION_COLUMNS, F.lit(1).alias("_new"))
    )
    order = [*survivor_order(both.select(*OBSERVATION_COLUMNS)), F.col("_new")]
    key = Window.partitionBy("place", hour_bucket(F.col("observed_at"))).orderBy(*order)
    ranked = both.withColumn("_rank", F.row_number().over(key))
    # Of two rows the second goes if it is the old one; a key's only old row stays.
    comes, goes = (F.col("_rank") == 1) & (F.col("_new") == 1), (F.col("_rank") == 2) & (F.col("_new") == 0)
    kept = ranked.where(comes | goes).withColumn("op", F.when(comes, INSERT).otherwise(RETRACT))
    return add_features(kept, "op").withColumn(SILVER_PARTITION, F.to_date("observed_at"))


def _changes(spark: SparkSession, live: LiveTables) -> DataFrame:
    return spark.read.schema(CHANGE_SCHEMA).parquet(live.stage("changes"))


def _stage_changes(live: LiveTables, obs: DataFrame) -> None:
    """Write the changes that observations make; rows without a place or a time make none."""
    spark = obs.sparkSession
    arrived = live.stage("arrivals")
    new = add_features(deduplicate(obs.select(*OBSERVATION_COLUMNS))).withColumn(SILVER_PARTITION, F.to_date("observed_at"))
    new.write.mode("overwrite").parquet(arrived)
    arrivals = spark.read.schema(SILVER_SCHEMA).parquet(arrived)
    changes = changes_between(_silver_at(spark, live, hours_of(arrivals)), arrivals)
    named = changes.withColumn("change", F.lit(uuid.uuid4().hex)).select(*CHANGE_SCHEMA.names)
    named.write.mode("overwrite").parquet(live.stage("changes"))
    remove(spark, arrived)


def _silver_after(old: DataFrame, changes: DataFrame) -> DataFrame:
    """Hours of Silver with the changes applied; applied again they change nothing."""
    keys = changes.select("place", *SILVER_HOURS).distinct()
    comes = changes.where(F.col("op") == INSERT).select(*SILVER_SCHEMA.names)
    return old.select(*SILVER_SCHEMA.names).join(keys, ["place", *SILVER_HOURS], "left_anti").select(*SILVER_SCHEMA.names).unionByName(comes)


def _fact_after(old: DataFrame, changes: DataFrame, scale: int | None) -> DataFrame:
    """Hours of the fact with the changes applied. A place and hour is one row of Silver, and so one group of the fact."""
    comes = fact_from_same_silver(changes.where(F.col("op") == INSERT).select(*SILVER.names), scale)
    day = F.date_format(SILVER_PARTITION, "yyyyMMdd").cast("int").alias("date_key")
    keys = changes.select(location_key(F.col("place")).alias("location_key"), day, "observation_hour").distinct()
    return old.join(keys, ["location_key", *FACT_HOURS], "left_anti").select(*comes.columns).unionByName(comes)


def _read_states(spark: SparkSession, live: LiveTables, version: str | None) -> dict[str, DataFrame]:
    if version is None:
        return {name: spark.createDataFrame([], schema) for name, schema in STATES.items()}
    return {name: spark.read.schema(s).parquet(pub.run_path(live.dimensions, version, name)) for name, s in STATES.items()}


def _published(spark: SparkSession, live: LiveTables) -> str | None:
    return pub.published_run(spark, live.dimensions) if path_exists(spark, f"{live.dimensions}/{pub.LOG}") else None


def _equal(a: str, b: str, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def _locations_after(spark: SparkSession, live: LiveTables, state: DataFrame, changes: DataFrame) -> DataFrame:
    """The latest row of every place, those of places without a change as they are stored.

    A row that comes in can only be later or not. A latest row that goes, while none later comes in, leaves its place to
    a row of Silver that no state holds: such places, which are rare, are looked up there.
    """
    comes, goes = (changes.where(F.col("op") == op).select(*LOCATION_ROW) for op in (INSERT, RETRACT))
    touched = comes.select("place").distinct()
    others = state.join(touched, "place", "left_anti").select(*LOCATION_ROW)
    latest = latest_rows(state.join(touched, "place", "left_semi").select(*LOCATION_ROW).unionByName(comes))
    gone = latest.alias("l").join(goes.distinct().alias("g"), _equal("l", "g", LOCATION_ROW)).select("l.place")
    back = latest.alias("l").join(comes.distinct().alias("c"), _equal("l", "c", LOCATION_ROW), "left_semi").select("l.place")
    lost = gone.join(back, "place", "left_anti").distinct()
    if lost.isEmpty():
        return others.unionByName(latest)
    silver = read_silver(spark, live.silver, keep_date=True).select(*SILVER_SCHEMA.names).join(lost, "place", "left_semi")
    found = latest_rows(_silver_after(silver, changes.join(lost, "place", "left_semi").select(*changes.columns)))
    return others.unionByName(latest.join(lost, "place", "left_anti").select(*LOCATION_ROW)).unionByName(found)


def _stage_dimensions(spark: SparkSession, live: LiveTables, changes: DataFrame, version: str) -> dict[str, DataFrame]:
    """The next version of the stored dimensions, written but not published. A place or date never goes: with a row that
    goes another of the same place and hour comes in; a weather goes with its last row."""
    old = _read_states(spark, live, _published(spark, live))
    pair = ["weather_code", "weather_description"]
    step = F.when(F.col("op") == INSERT, 1).otherwise(-1).cast("bigint")
    steps = changes.groupBy(*pair).agg(F.sum(step).alias("n"))
    dates = changes.select(F.col(SILVER_PARTITION).alias("full_date")).distinct()

    def weathers() -> DataFrame:
        met = lambda how: old["dim_weather"].alias("a").join(steps.alias("b"), _equal("a", "b", pair), how)
        counted = met("left_semi").unionByName(steps).groupBy(*pair).agg(F.sum("n").alias("n"))
        return met("left_anti").unionByName(counted.where("n > 0"))

    after = {
        "dim_location": lambda: _locations_after(spark, live, old["dim_location"], changes),
        "dim_date": lambda: old["dim_date"].unionByName(dates.join(old["dim_date"], "full_date", "left_anti")),
        "dim_weather": weathers,
    }
    for name, plan in after.items():
        path = pub.run_path(live.dimensions, version, name)
        if not path_exists(spark, f"{path}/_SUCCESS"):
            plan().write.mode("overwrite").parquet(path)
    return _read_states(spark, live, version)


def dimensions(states: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dimensions of the star schema, off the stored ones. What is stored twice is here twice."""
    return {
        "dim_location": keyed_locations(states["dim_location"]),
        "dim_date": keyed_dates(states["dim_date"]),
        "dim_weather": keyed_weathers(states["dim_weather"]),
    }


def gate_hours(fact: DataFrame, dims: dict[str, DataFrame]) -> None:
    """Raise unless the fact's hours pass the star schema's tests against the stored dimensions.

    References are looked up in, and unique tests made on, the stored rows of those keys that occur in these hours.
    """
    key_of = {"dim_location": "location_key", "dim_date": "date_key", "dim_weather": "weather_key"}
    met = {name: dims[name].join(fact.select(key).distinct(), key, "left_semi") for name, key in key_of.items()}
    gate(met | {"fact_hourly_weather": fact})


def _apply(spark: SparkSession, live: LiveTables, scale: int | None) -> list[dt.date]:
    """Put staged changes in place, or take up where a run before stopped; raises and drops them if a test fails."""
    changes = _changes(spark, live)
    head = changes.select("change").first()
    if head is None or head[0] == _published(spark, live):
        remove(spark, live.stage("changes"))
        return []
    version, hours = head[0], hours_of(changes)
    silver = staged(_silver_after(_silver_at(spark, live, hours), changes), live.stage("silver"))
    fact_schema = GOLD["fact_hourly_weather"]
    if path_exists(spark, live.fact):
        old = read_gold_table(spark, live.fact, "fact_hourly_weather").where(_within(hours, live, FACT_PARTITION))
    else:
        old = spark.createDataFrame([], fact_schema)
    fact = staged(_fact_after(old, changes, scale), live.stage("fact"))
    states = _stage_dimensions(spark, live, changes, version)
    try:
        gate_hours(fact, dimensions(states))
    except Exception:
        # The changes go last: without them nothing that is left of this update counts.
        for path in (live.stage("silver"), live.stage("fact"), pub.run_path(live.dimensions, version), live.stage("changes")):
            remove(spark, path)
        raise
    _finish_replacements(spark, live)
    pub.publish_run(spark, live.dimensions, version)
    remove(spark, live.stage("changes"))
    pub.drop_versions(spark, live.dimensions, KEPT_VERSIONS)
    return sorted({day for day, _ in hours})


def finish_update(spark: SparkSession, live: LiveTables, scale: int | None = None) -> list[dt.date]:
    """Finish what a run before left half-way; returns the dates rewritten."""
    if path_exists(spark, f"{live.stage('changes')}/_SUCCESS"):
        return _apply(spark, live, scale)
    _finish_replacements(spark, live)
    return []


def _finish_replacements(spark: SparkSession, live: LiveTables) -> None:
    fact = GOLD["fact_hourly_weather"]
    finish_replacement(spark, SILVER_SCHEMA, live.silver, live.stage("silver"), live.silver_parts, arranged=False)
    finish_replacement(spark, fact, live.fact, live.stage("fact"), live.fact_parts, arranged=False)


def update(live: LiveTables, obs: DataFrame, scale: int | None = None) -> list[dt.date]:
    """Fold observations into the live tables; returns the dates in which hours were rewritten.

    Observations that change nothing rewrite nothing, so updating again with the same ones is safe. If the result fails
    a test of the star schema, it raises and the live tables stay as they were.
    """
    spark = obs.sparkSession
    finish_update(spark, live, scale)
    _stage_changes(live, obs)
    return _apply(spark, live, scale)


def start_live(stream: DataFrame, live: LiveTables, checkpoint: str, scale: int | None = None) -> StreamingQuery:
    """Fold a stream of observations into the live tables until nothing new is available; a batch that fails its tests
    ends the stream, and the tables stay as the batch before left them."""
    return (
        stream.writeStream.foreachBatch(lambda batch, _: update(live, batch, scale))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_states(spark: SparkSession, live: LiveTables) -> dict[str, DataFrame]:
    """The stored dimensions as they are kept."""
    return _read_states(spark, live, _published(spark, live))


def read_dimensions(spark: SparkSession, live: LiveTables) -> dict[str, DataFrame]:
    return dimensions(stored_states(spark, live))
