"""Landed responses to Bronze as a stream: each file is taken once."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cirrolake.operators.bronze import current_to_bronze, history_to_bronze
from cirrolake.sinks.tables import append_bronze
from cirrolake.sources.responses import classified, stream_responses

FEEDS: dict[str, Callable[[DataFrame, dt.datetime], DataFrame]] = {
    "current": current_to_bronze,
    "history": history_to_bronze,
}


def start_intake(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    feed: str = "current",
    ingested_at: dt.datetime | None = None,
    max_files: int | None = None,
    appended: list[int] | None = None,
) -> StreamingQuery:
    """Take what has landed since the last call and stop. One ingest time per call; `appended` gets each batch's rows.

    What is no observation is kept too, apart from the others: see `tables.read_rejected_bronze`.

    A batch is named after the stream and its number, so one that runs again after a failure replaces itself, and any
    number of feeds, streams and batch appends may share one Bronze table.
    """
    wrap = FEEDS[feed]
    batch_time = ingested_at or dt.datetime.now(dt.UTC)
    stream = f"{feed}-{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}"

    def write(batch: DataFrame, number: int) -> None:
        rows = append_bronze(wrap(classified(batch, feed), batch_time), bronze, f"{stream}-{number}")
        if appended is not None:
            appended.append(rows)

    return (
        stream_responses(spark, landing, max_files=max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
