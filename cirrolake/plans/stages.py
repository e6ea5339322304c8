"""The stages of a run: landed responses, Bronze, Silver, Gold."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrolake.operators import bronze as bz
from cirrolake.operators.dimensions import dim_date, dim_location, dim_weather
from cirrolake.operators.fact import fact_from_same_silver
from cirrolake.operators.quality import gate
from cirrolake.operators.silver import bronze_to_silver_and_rejects, observations
from cirrolake.plans.dashboard import Gold
from cirrolake.schemas import GOLD
from cirrolake.sinks import publish as pub
from cirrolake.sinks.tables import append_bronze, write_fact, write_silver_and_rejects
from cirrolake.sources.responses import classified, read_responses
from cirrolake.sources.tables import read_bronze, read_gold_table, read_rejected_bronze, read_rejected_silver, read_silver
from cirrolake.streaming import live
from cirrolake.streaming.intake import start_intake


@dataclass(frozen=True)
class Lake:
    """The folders of one lakehouse below a common root; the live tables have one for each hour, or for each date."""

    root: str
    live_by_hour: bool = True

    @property
    def bronze(self) -> str:
        return f"{self.root.rstrip('/')}/bronze/weather_events"

    @property
    def silver(self) -> str:
        return f"{self.root.rstrip('/')}/silver/weather_observations"

    @property
    def gold(self) -> str:
        return f"{self.root.rstrip('/')}/gold"

    @property
    def live(self) -> str:
        """Tables that are updated in place, date by date."""
        return f"{self.root.rstrip('/')}/live"


def _short(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()[:12]


def ingest_current(spark: SparkSession, landing: str, lake: Lake, ingested_at: dt.datetime) -> int:
    """Append current-conditions responses to Bronze, each landed file once; returns the number of rows."""
    appended: list[int] = []
    checkpoint = f"{lake.root.rstrip('/')}/checkpoints/current-{_short(landing)}"
    start_intake(spark, landing, lake.bronze, checkpoint, "current", ingested_at, appended=appended).awaitTermination()
    return sum(appended)


def backfill(
    spark: SparkSession, landing: str, lake: Lake, ingested_at: dt.datetime, start: dt.date, end: dt.date
) -> int:
    """Append landed history responses to Bronze, the observations from `start` up to and including `end`.

    The same backfill again replaces what it appended. What is no observation is kept apart, whatever the range.
    """
    low = dt.datetime.combine(start, dt.time(), dt.UTC).timestamp()
    high = dt.datetime.combine(end + dt.timedelta(days=1), dt.time(), dt.UTC).timestamp()
    rows = classified(read_responses(spark, landing), "history", (low, high))
    batch = f"backfill-{_short(landing)}-{start}-{end}"
    return append_bronze(bz.history_to_bronze(rows, ingested_at), lake.bronze, batch)


@dataclass(frozen=True)
class SilverRun:
    """What a refresh of Silver read and wrote; run_id is None when there was nothing to publish.

    Every row read is written, rejected, or a duplicate. `attempt` names the version also when it was not published.
    """

    run_id: str | None
    rows_read: int
    rows_written: int
    rows_rejected: int
    attempt: str

    @property
    def rows_removed(self) -> int:
        """Rows without a place or a readable time, and all but one of each place and hour."""
        return self.rows_read - self.rows_written

    @property
    def duplicates(self) -> int:
        return self.rows_removed - self.rows_rejected


def refresh_silver(spark: SparkSession, lake: Lake) -> SilverRun:
    """Full refresh of Silver from Bronze; publishes the new version unless it has no rows.

    Rows that give no observation are written beside it, with their reason and payload.
    """
    bronze = read_bronze(spark, lake.bronze)
    run_id = pub.new_run_id()
    written, rejected = write_silver_and_rejects(bronze_to_silver_and_rejects(bronze), pub.run_path(lake.silver, run_id))
    if written:
        pub.publish_run(spark, lake.silver, run_id)
    # Counted from the files' footers.
    return SilverRun(run_id if written else None, bronze.count(), written, rejected, run_id)


def rejects(spark: SparkSession, lake: Lake, silver_run: str | None = None) -> DataFrame:
    """(stage, source, reason, payload, ingested_at) of everything landed that is not in Silver, duplicates aside.

    Of Silver's versions the published one counts, or `silver_run`.
    """
    run_id = silver_run or pub.published_run(spark, lake.silver)
    landed, refined = read_rejected_bronze(spark, lake.bronze), read_rejected_silver(spark, pub.run_path(lake.silver, run_id))
    columns = ["source", "reason", "payload", "ingested_at"]
    stage = lambda df, name: df.select(F.lit(name).alias("stage"), *columns)
    return stage(landed, "bronze").unionByName(stage(refined, "silver"))


def build_silver(spark: SparkSession, lake: Lake) -> str | None:
    """The version that a refresh of Silver has published, or None when there are no rows."""
    return refresh_silver(spark, lake).run_id


def current_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_silver(spark, pub.run_path(lake.silver, pub.published_run(spark, lake.silver)))


def gold_tables(silver: DataFrame, scale: int | None = None) -> Gold:
    """The star schema of one Silver version, as plans."""
    return Gold(
        dim_location(silver), dim_date(silver), dim_weather(silver), fact_from_same_silver(silver, scale)
    )


def read_gold(spark: SparkSession, lake: Lake, run_id: str | None = None) -> Gold:
    run_id = run_id or pub.published_run(spark, lake.gold)
    return Gold(
        *[read_gold_table(spark, pub.run_path(lake.gold, run_id, table), table) for table in GOLD]
    )


def write_gold(silver: DataFrame, lake: Lake, run_id: str) -> Gold:
    """Write the star schema of a Silver table as a version, not yet published, and read it back."""
    planned = gold_tables(silver)
    for table in ("dim_location", "dim_date", "dim_weather"):
        getattr(planned, table).write.parquet(pub.run_path(lake.gold, run_id, table))
    write_fact(planned.fact_hourly_weather, pub.run_path(lake.gold, run_id, "fact_hourly_weather"))
    return read_gold(silver.sparkSession, lake, run_id)


def build_gold(spark: SparkSession, lake: Lake, database: str | None = None) -> str:
    """Write the star schema as a new version, test it, and publish it only if every test passes."""
    run_id = pub.new_run_id()
    gate(vars(write_gold(current_silver(spark, lake), lake, run_id)))
    pub.publish_run(spark, lake.gold, run_id)
    pub.repoint_views(spark, lake.gold, run_id, list(GOLD), database)
    return run_id


def live_tables(lake: Lake) -> live.LiveTables:
    return live.LiveTables(lake.live, lake.live_by_hour)


def update_live(spark: SparkSession, lake: Lake, since: dt.date) -> list[dt.date]:
    """Fold the Bronze partitions from `since` on into the live star schema; returns the dates with rewritten hours.

    Only hours in which a row changes are rewritten. They are tested against the stored dimensions before they replace
    old ones: a batch that fails raises and leaves the live tables as they were. What a run before it left half-way is
    finished first. Updating again with the same or an earlier `since` changes nothing, so a failed run is repeated as
    it was.
    """
    return live.update(live_tables(lake), observations(read_bronze(spark, lake.bronze, since)))


def read_live(spark: SparkSession, lake: Lake) -> Gold:
    """The star schema over the live tables and the stored dimensions.

    An update replaces files, so read again after one. Readers that must not notice updates use a published version.
    """
    tables = live_tables(lake)
    fact = read_gold_table(spark, tables.fact, "fact_hourly_weather")
    return Gold(**live.read_dimensions(spark, tables), fact_hourly_weather=fact)


def run_all(
    spark: SparkSession, landing: str, lake: Lake, ingested_at: dt.datetime, database: str | None = None
) -> Gold:
    """Bronze, then Silver, then Gold; the first failure ends the run and leaves the published versions as they were."""
    ingest_current(spark, landing, lake, ingested_at)
    build_silver(spark, lake)
    return read_gold(spark, lake, build_gold(spark, lake, database))
