"""Table schemas of the three layers and the payload fields that Silver reads."""

from __future__ import annotations

from pyspark.sql import types as T

DOUBLE, STRING, TIMESTAMP, DATE = T.DoubleType(), T.StringType(), T.TimestampType(), T.DateType()
INT, LONG, BOOLEAN = T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Column names, order and types of the data model.
BRONZE = _struct(
    ("observation_id", STRING),
    ("source", STRING),
    ("raw_payload", STRING),
    ("lat", DOUBLE),
    ("lon", DOUBLE),
    ("_ingested_at", TIMESTAMP),
    ("ingest_date", DATE),
)

SILVER = _struct(
    ("id", STRING),
    ("source", STRING),
    ("ingested_at", TIMESTAMP),
    ("place", STRING),
    ("api_city", STRING),
    ("country", STRING),
    ("latitude", DOUBLE),
    ("longitude", DOUBLE),
    ("observed_at", TIMESTAMP),
    ("temperature", DOUBLE),
    ("apparent_temperature", DOUBLE),
    ("humidity", DOUBLE),
    ("pressure", DOUBLE),
    ("sea_level_pressure", DOUBLE),
    ("wind_speed", DOUBLE),
    ("wind_direction", DOUBLE),
    ("wind_gust", DOUBLE),
    ("precipitation", DOUBLE),
    ("cloud_cover", DOUBLE),
    ("uv_index", DOUBLE),
    ("visibility", DOUBLE),
    ("aqi", DOUBLE),
    ("weather_code", DOUBLE),
    ("weather_description", STRING),
    ("observation_hour", INT),
    ("day_of_week", STRING),
    ("month", INT),
    ("wind_category", STRING),
    ("uv_category", STRING),
)

DIM_LOCATION = _struct(
    ("location_key", STRING),
    ("place", STRING),
    ("api_city", STRING),
    ("country", STRING),
    ("latitude", DOUBLE),
    ("longitude", DOUBLE),
)

DIM_DATE = _struct(
    ("date_key", INT),
    ("full_date", DATE),
    ("year", LONG),
    ("quarter", LONG),
    ("month", LONG),
    ("month_name", STRING),
    ("day", LONG),
    ("day_of_week_sun_0", LONG),
    ("day_name", STRING),
    ("is_weekend", BOOLEAN),
)

DIM_WEATHER = _struct(("weather_key", STRING), ("weather_code", DOUBLE), ("weather_description", STRING))

FACT_HOURLY_WEATHER = _struct(
    ("location_key", STRING),
    ("date_key", INT),
    ("weather_key", STRING),
    ("observation_hour", INT),
    ("avg_temperature_celsius", DOUBLE),
    ("avg_feels_like_celsius", DOUBLE),
    ("avg_humidity_percent", DOUBLE),
    ("max_wind_speed_ms", DOUBLE),
    ("avg_cloud_coverage_percent", DOUBLE),
    ("total_precipitation_mmh", DOUBLE),
    ("observation_count", LONG),
)

GOLD = {
    "dim_location": DIM_LOCATION,
    "dim_date": DIM_DATE,
    "dim_weather": DIM_WEATHER,
    "fact_hourly_weather": FACT_HOURLY_WEATHER,
}

# Payload key -> Silver column.
PAYLOAD_NAMES = {
    "place_name": "place",
    "city_name": "api_city",
    "country_code": "country",
    "lat": "latitude",
    "lon": "longitude",
    "ts": "observed_at",
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

# Key inside the payload's `weather` object -> column.
WEATHER_NAMES = {"code": "weather_code", "description": "weather_description", "icon": "weather_icon"}

# The columns that come straight from Bronze and the payload; the rest of Silver is derived from them.
OBSERVATION_COLUMNS = [f.name for f in SILVER.fields[:24]]

#: Beside Silver's columns in rows that it rejects.
REJECT_COLUMNS = ["reason", "raw_payload"]

CORRUPT = "_corrupt_record"

# `ts` comes as a number or as text; a bigint field would turn 1761800400.0 and "1761800400" into null.
PAYLOAD = T.StructType(
    [
        T.StructField(key, STRING if key == "ts" else SILVER[column].dataType)
        for key, column in PAYLOAD_NAMES.items()
    ]
    + [
        T.StructField("weather", _struct(("code", DOUBLE), ("description", STRING), ("icon", STRING))),
        T.StructField(CORRUPT, STRING),
    ]
)

LOCATIONS = _struct(("name", STRING), ("latitude", DOUBLE), ("longitude", DOUBLE))
