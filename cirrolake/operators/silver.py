"""Bronze to Silver: parse, rename, conform, clean, deduplicate, enrich."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cirrolake.functions.bins import uv_category, wind_category
from cirrolake.functions.calendar import day_name, epoch_to_timestamp, hour_bucket
from cirrolake.operators.dedupe import first_per_key, total_order
from cirrolake.schemas import CORRUPT, DOUBLE, OBSERVATION_COLUMNS, PAYLOAD, PAYLOAD_NAMES, REJECT_COLUMNS, SILVER, WEATHER_NAMES


def _parse(bronze: DataFrame, *others: str) -> DataFrame:
    """The payload's declared fields, parsed once; keys outside them are ignored.

    Through `inline` the fields are a generator's output: a later filter on them stays above it. On a plain projection
    the optimizer would push the filter below and parse every payload again for it.
    """
    payload = F.from_json("raw_payload", PAYLOAD, {"columnNameOfCorruptRecord": CORRUPT})
    return bronze.select(
        F.col("observation_id").alias("id"),
        "source",
        F.col("_ingested_at").alias("ingested_at"),
        *others,
        F.inline(F.array(payload)),
    )


def _is_malformed(parsed: Column, text: Column) -> Column:
    """Spark flags wrong field types too; only text that is no JSON at all counts, and only flagged rows are re-read."""
    return parsed[CORRUPT].isNotNull() & F.try_parse_json(text).isNull()


def quarantine(bronze: DataFrame) -> DataFrame:
    """Bronze rows whose payload is not JSON."""
    flagged = F.from_json("raw_payload", PAYLOAD, {"columnNameOfCorruptRecord": CORRUPT})
    return bronze.where(_is_malformed(flagged, F.col("raw_payload")))


def _clean(column: Column) -> Column:
    """NaN means missing: it would win every maximum and spoil every sum."""
    return F.nanvl(column, F.lit(None).cast("double"))


# Why a Bronze row gives no observation.
PAYLOAD_NOT_JSON, NO_PLACE, UNREADABLE_TIME = "payload_not_json", "no_place", "unreadable_time"


def observations(bronze: DataFrame) -> DataFrame:
    """Bronze payloads as the 24 business columns; payloads that are not JSON come out with nulls only."""
    return _observations(_parse(bronze))


def classified(bronze: DataFrame) -> DataFrame:
    """The same with REJECT_COLUMNS: why a row is no observation, and then its payload; both null for observations."""
    rows = _observations(_parse(bronze, "raw_payload"), CORRUPT, "raw_payload")
    malformed = F.col(CORRUPT).isNotNull() & F.try_parse_json("raw_payload").isNull()
    reason = (
        F.when(F.col("raw_payload").isNull() | malformed, PAYLOAD_NOT_JSON)
        .when(F.col("place").isNull(), NO_PLACE)
        .when(F.col("observed_at").isNull(), UNREADABLE_TIME)
    )
    # Only rows that would be dropped are looked at more closely.
    doubtful = F.col("place").isNull() | F.col("observed_at").isNull()
    judged = rows.withColumn("reason", F.when(doubtful, reason))
    return judged.select(*OBSERVATION_COLUMNS, "reason", F.when(F.col("reason").isNotNull(), F.col("raw_payload")).alias("raw_payload"))


def _observations(parsed: DataFrame, *others: str) -> DataFrame:
    columns = {name: F.col(key) for key, name in PAYLOAD_NAMES.items()}
    columns |= {name: F.col("weather")[key] for key, name in WEATHER_NAMES.items()}
    columns["observed_at"] = epoch_to_timestamp(columns["observed_at"])
    for name in ("id", "source", "ingested_at"):
        columns[name] = F.col(name)
    return parsed.select(
        *[
            (_clean(columns[n]) if SILVER[n].dataType == DOUBLE else columns[n]).alias(n)
            for n in OBSERVATION_COLUMNS
        ],
        *others,
    )


def conform(df: DataFrame) -> DataFrame:
    """The 24 observation columns in order: absent ones as nulls, others dropped, types as in Silver."""
    have = set(df.columns)
    picked = []
    for name in OBSERVATION_COLUMNS:
        kind = SILVER[name].dataType
        column = (F.col(name) if name in have else F.lit(None)).cast(kind)
        picked.append((_clean(column) if kind == DOUBLE else column).alias(name))
    return df.select(*picked)


def deduplicate(obs: DataFrame) -> DataFrame:
    """Per place and UTC hour the earliest observation; then the latest ingested, then the smallest id.

    Rows without a time or a place are dropped.
    """
    keyed = obs.where(F.col("observed_at").isNotNull() & F.col("place").isNotNull())
    return first_per_key(keyed, ["place", hour_bucket(F.col("observed_at"))], survivor_order(keyed))


def deduplicate_accepted(classified: DataFrame) -> DataFrame:
    """The same of classified rows, with every rejected row beside it.

    A rejected row is a key of its own, so that many of them are no hot key.
    """
    own = F.when(F.col("reason").isNotNull(), F.monotonically_increasing_id())
    order = survivor_order(classified.select(*OBSERVATION_COLUMNS))
    return first_per_key(classified.withColumn("_own", own), ["place", hour_bucket(F.col("observed_at")), "_own"], order).drop("_own")


def survivor_order(obs: DataFrame) -> list[Column]:
    """The order in which the first row of a place and hour survives; total but for rows that are equal."""
    return total_order(
        obs,
        F.col("observed_at").asc(),
        F.col("ingested_at").desc_nulls_last(),
        F.col("id").asc_nulls_last(),
    )


def add_features(obs: DataFrame, *others: str) -> DataFrame:
    """Hour, weekday, month and the wind and UV categories, then Silver's exact schema, and after it `others` of `obs`."""
    ts = F.col("observed_at")
    enriched = obs.withColumns(
        {
            "observation_hour": F.hour(ts),
            "day_of_week": day_name(ts),
            "month": F.month(ts),
            "wind_category": wind_category(F.col("wind_speed")),
            "uv_category": uv_category(F.col("uv_index")),
        }
    )
    return enriched.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER], *others)


def to_silver(obs: DataFrame) -> DataFrame:
    """Silver from observation columns."""
    return add_features(deduplicate(conform(obs)))


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    return add_features(deduplicate(observations(bronze)))


def bronze_to_silver_and_rejects(bronze: DataFrame) -> DataFrame:
    """Silver, and after its columns REJECT_COLUMNS: rows with a reason are not Silver's. One parse gives both."""
    return add_features(deduplicate_accepted(classified(bronze)), *REJECT_COLUMNS)
