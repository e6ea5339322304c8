"""Weather observations made from the given tables, which hold none.

Each event becomes one observation: the place follows from the user, the weather from the event type, the measures from
`value` and from `k` in `props`. `oracle.py` states the same mapping in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cirrolake.operators.silver import to_silver

BATCH_TIME = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)

WEATHER_CODES = {"view": 800.0, "click": 801.0, "purchase": 500.0, "signup": 200.0, "error": 741.0}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def weather_code() -> Column:
    code = F.lit(None).cast("double")
    for kind, value in WEATHER_CODES.items():
        code = F.when(F.col("event_type") == kind, F.lit(value)).otherwise(code)
    return code


def observation_columns(gaps: bool = False) -> dict[str, Column]:
    """Silver's observation columns over `events`; with `gaps` the errors have no weather code."""
    k = F.get_json_object("props", "$.k").cast("int")
    place_no = F.col("user_id") % 25
    observed = F.date_trunc("second", F.col("ts").cast("timestamp"))
    code = F.when(F.col("event_type") != "error", weather_code()) if gaps else weather_code()
    return {
        "id": F.col("event_id").cast("string"),
        "source": F.lit("events"),
        "ingested_at": observed + F.make_dt_interval(mins=(F.col("event_id") % 7).cast("int")),
        "place": F.concat(F.lit("NATION_"), place_no.cast("string")),
        "api_city": F.concat(F.lit("STATION_"), F.col("user_id").cast("string")),
        "country": F.concat(F.lit("C"), (F.col("user_id") % 5).cast("string")),
        "latitude": F.lit(8.5) + place_no.cast("double") * 0.61 + F.col("user_id").cast("double") * 0.001,
        "longitude": F.lit(102.1) + place_no.cast("double") * 0.37,
        "observed_at": observed,
        "temperature": F.col("value") / 10.0,
        "apparent_temperature": F.col("value") / 10.0 - 1.5,
        "humidity": k.cast("double"),
        "pressure": k + F.lit(1000.0),
        "sea_level_pressure": k + F.lit(1001.5),
        "wind_speed": F.col("value") / 10.0,
        "wind_direction": ((F.col("event_id") * 37) % 360).cast("double"),
        "wind_gust": F.col("value") / 8.0,
        "precipitation": k / F.lit(4.0),
        "cloud_cover": ((k * 7) % 101).cast("double"),
        "uv_index": k / F.lit(6.0),
        "visibility": k / F.lit(2.0),
        "aqi": F.when(F.col("event_type") != "error", k + F.lit(20.0)),
        "weather_code": code,
        "weather_description": F.col("event_type"),
    }


def observations(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return as_observations(events, gaps)


def as_observations(events: DataFrame, gaps: bool = False) -> DataFrame:
    return events.select(*[c.alias(n) for n, c in observation_columns(gaps).items()])


def silver(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    return to_silver(observations(spark, sf_dir, gaps))


def _payload(shift: int = 0) -> Column:
    """One observation as the weather API would write it, `shift` seconds later."""
    c = observation_columns()
    names = {
        "lat": "latitude",
        "lon": "longitude",
        "city_name": "api_city",
        "country_code": "country",
        "temp": "temperature",
        "app_temp": "apparent_temperature",
        "rh": "humidity",
        "pres": "pressure",
        "slp": "sea_level_pressure",
        "wind_spd": "wind_speed",
        "wind_dir": "wind_direction",
        "gust": "wind_gust",
        "precip": "precipitation",
        "clouds": "cloud_cover",
        "uv": "uv_index",
        "vis": "visibility",
        "aqi": "aqi",
    }
    weather = F.struct(
        c["weather_code"].alias("code"), c["weather_description"].alias("description"), F.lit("c01d").alias("icon")
    )
    return F.struct(
        (F.unix_seconds(c["observed_at"]) + shift).alias("ts"),
        *[c[column].alias(key) for key, column in names.items()],
        weather.alias("weather"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A current-conditions response per event, as `place_name` and `body`."""
    place = observation_columns()["place"]
    body = F.to_json(F.struct(place.alias("place_name"), F.array(_payload()).alias("data")))
    return table(spark, sf_dir, "events").select(place.alias("place_name"), body.alias("body"))


def uneven_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of every shape: errors lack `data`, sign-ups have an empty one, purchases hold two observations."""
    place = observation_columns()["place"].alias("place_name")
    kind = F.col("event_type")
    none = F.to_json(F.struct(place, F.lit("busy").alias("error")))
    empty = F.to_json(F.struct(place, F.array().cast("array<string>").alias("data")))
    two = F.to_json(F.struct(place, F.array(_payload(), _payload(1800)).alias("data")))
    one = F.to_json(F.struct(place, F.array(_payload()).alias("data")))
    body = F.when(kind == "error", none).when(kind == "signup", empty).when(kind == "purchase", two).otherwise(one)
    return table(spark, sf_dir, "events").select(place, body.alias("body"))


def dirty_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which most are broken, each in a way that follows from the event's number.

    0 cut off, 1 no object, 2 `data` no array, 3 `data` with elements that are no objects, 4 no place, 5 a time that is no
    number, 6 a time too far off, 7 no `data`, 8 no time; 9 is sound.
    """
    place = observation_columns()["place"].alias("place_name")
    shape = F.col("event_id") % 10
    sound = F.to_json(F.struct(place, F.array(_payload()).alias("data")))
    timed = lambda ts: F.regexp_replace(sound, '"ts":[0-9]+', f'"ts":{ts}')
    body = (
        F.when(shape == 0, F.substring(sound, 1, 40))
        .when(shape == 1, F.lit("[1, 2]"))
        .when(shape == 2, F.to_json(F.struct(place, F.lit("busy").alias("data"))))
        .when(shape == 3, F.regexp_replace(sound, r"\]\}$", ', 5, null, "x"]}'))
        .when(shape == 4, F.to_json(F.struct(F.array(_payload()).alias("data"))))
        .when(shape == 5, timed('"never"'))
        .when(shape == 6, timed("99999999999"))
        .when(shape == 7, F.to_json(F.struct(place)))
        .when(shape == 8, timed("null"))
        .otherwise(sound)
    )
    return table(spark, sf_dir, "events").select(place, body.alias("body"))


def history_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history response per lineitem: the order is its metadata, the item its observation.

    Items without tax write a null status of their own, which must win over the order's; returned items already have
    a `gust`, which the item's `wind_gust_spd` must replace.
    """
    items = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    place = F.concat(F.lit("SUPPLIER_"), (F.col("l_suppkey") % 25).cast("string")).alias("place_name")
    ts = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 3600
    common = [ts.alias("ts"), F.col("l_quantity").alias("temp"), F.col("l_linenumber").alias("line")]
    gust = F.col("l_extendedprice").alias("wind_gust_spd")
    status = F.lit(None).cast("string").alias("status")
    old_gust = F.lit(1.0).alias("gust")
    # One key set each; to_json must keep the nulls of the keys that are there.
    keep = {"ignoreNullFields": "false"}

    def body(*extra: Column) -> Column:
        return F.to_json(
            F.struct(
                place,
                F.col("o_orderkey").alias("order"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_totalprice").alias("aqi"),
                F.array(F.struct(*common, *extra)).alias("data"),
            ),
            keep,
        )

    untaxed, returned = F.col("l_tax") == 0, F.col("l_returnflag") == "R"
    text = (
        F.when(untaxed & returned, body(gust, status, old_gust))
        .when(untaxed, body(gust, status))
        .when(returned, body(gust, old_gust))
        .otherwise(body(F.col("l_extendedprice").alias("other")))
    )
    return items.select(place, text.alias("body"))


def items_as_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations that were never deduplicated, so that fact rows hold many of them."""
    items = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("l_linenumber"))
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("p_brand").alias("place"),
        at.alias("observed_at"),
        at.alias("ingested_at"),
        F.lit(None).cast("string").alias("api_city"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.col("l_quantity").alias("temperature"),
        F.col("l_discount").alias("apparent_temperature"),
        F.col("l_tax").alias("humidity"),
        F.col("l_extendedprice").alias("wind_speed"),
        F.col("p_retailprice").alias("cloud_cover"),
        F.col("l_quantity").alias("precipitation"),
        F.col("p_size").cast("double").alias("weather_code"),
        F.col("p_type").alias("weather_description"),
        F.hour(at).alias("observation_hour"),
    )


def nation_coordinates() -> dict[str, Column]:
    key = F.col("n_nationkey").cast("double")
    return {"latitude": F.lit(8.5) + key * 0.61, "longitude": F.lit(102.1) + key * 0.37}
