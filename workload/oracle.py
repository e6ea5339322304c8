"""The registered queries in DuckDB SQL, written apart from the engine on the same tables."""

from __future__ import annotations

BATCH = "TIMESTAMP '2024-02-01 00:00:00'"

FILTER_DATES = "DATE '2024-01-08' AND DATE '2024-01-14'"
FILTER_PLACES = "('NATION_3', 'NATION_7', 'NATION_11')"

# The observation columns of Silver, in its order.
SILVER_COLUMNS = [
    ("id", "VARCHAR"), ("source", "VARCHAR"), ("ingested_at", "TIMESTAMP"), ("place", "VARCHAR"),
    ("api_city", "VARCHAR"), ("country", "VARCHAR"), ("latitude", "DOUBLE"), ("longitude", "DOUBLE"),
    ("observed_at", "TIMESTAMP"), ("temperature", "DOUBLE"), ("apparent_temperature", "DOUBLE"),
    ("humidity", "DOUBLE"), ("pressure", "DOUBLE"), ("sea_level_pressure", "DOUBLE"), ("wind_speed", "DOUBLE"),
    ("wind_direction", "DOUBLE"), ("wind_gust", "DOUBLE"), ("precipitation", "DOUBLE"), ("cloud_cover", "DOUBLE"),
    ("uv_index", "DOUBLE"), ("visibility", "DOUBLE"), ("aqi", "DOUBLE"), ("weather_code", "DOUBLE"),
    ("weather_description", "VARCHAR"),
]
OBSERVATION_NAMES = ", ".join(n for n, _ in SILVER_COLUMNS)


def obs(gaps: bool = False) -> str:
    """`obs`: the observations that stand for the events."""
    error_code = "NULL" if gaps else "741.0"
    return f"""
event_rows AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id % 25 AS m,
         date_trunc('second', ts) AS sec
  FROM events
),
obs AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'events' AS source, sec + to_minutes(event_id % 7) AS ingested_at,
    'NATION_' || m AS place, 'STATION_' || user_id AS api_city, 'C' || (user_id % 5) AS country,
    CAST(8.5 AS DOUBLE) + CAST(m AS DOUBLE) * CAST(0.61 AS DOUBLE)
      + CAST(user_id AS DOUBLE) * CAST(0.001 AS DOUBLE) AS latitude,
    CAST(102.1 AS DOUBLE) + CAST(m AS DOUBLE) * CAST(0.37 AS DOUBLE) AS longitude,
    sec AS observed_at, value / CAST(10 AS DOUBLE) AS temperature,
    value / CAST(10 AS DOUBLE) - CAST(1.5 AS DOUBLE) AS apparent_temperature, CAST(k AS DOUBLE) AS humidity,
    CAST(1000 + k AS DOUBLE) AS pressure, CAST(k AS DOUBLE) + CAST(1001.5 AS DOUBLE) AS sea_level_pressure,
    value / CAST(10 AS DOUBLE) AS wind_speed, CAST((event_id * 37) % 360 AS DOUBLE) AS wind_direction,
    value / CAST(8 AS DOUBLE) AS wind_gust, CAST(k AS DOUBLE) / CAST(4 AS DOUBLE) AS precipitation,
    CAST((k * 7) % 101 AS DOUBLE) AS cloud_cover, CAST(k AS DOUBLE) / CAST(6 AS DOUBLE) AS uv_index,
    CAST(k AS DOUBLE) / CAST(2 AS DOUBLE) AS visibility,
    CASE WHEN event_type <> 'error' THEN CAST(k + 20 AS DOUBLE) END AS aqi,
    CAST(CASE event_type WHEN 'view' THEN 800.0 WHEN 'click' THEN 801.0 WHEN 'purchase' THEN 500.0
      WHEN 'signup' THEN 200.0 WHEN 'error' THEN {error_code} END AS DOUBLE) AS weather_code,
    event_type AS weather_description
  FROM event_rows
)"""


def six_digits(x: str) -> str:
    text = f"format('{{:.6g}}', {x})"
    return f"CASE WHEN contains({text}, '.') OR contains({text}, 'e') THEN {text} ELSE {text} || '.0' END"


def observation_id(source: str, lat: str, lon: str, ts: str) -> str:
    return f"sha256('{source}|' || {six_digits(lat)} || '|' || {six_digits(lon)} || '|' || CAST({ts} AS VARCHAR))"


EPOCH = "CAST(epoch(observed_at) AS BIGINT)"

# Keys of a payload in their order, and the columns they stand for.
PAYLOAD_KEYS = {
    "lat": "latitude", "lon": "longitude", "city_name": "api_city", "country_code": "country", "temp": "temperature",
    "app_temp": "apparent_temperature", "rh": "humidity", "pres": "pressure", "slp": "sea_level_pressure",
    "wind_spd": "wind_speed", "wind_dir": "wind_direction", "gust": "wind_gust", "precip": "precipitation",
    "clouds": "cloud_cover", "uv": "uv_index", "vis": "visibility", "aqi": "aqi",
}


def written(x: str) -> str:
    """A double as the landed documents write it: below a thousandth as digits and a power of ten."""
    text, digits = f"CAST(abs({x}) AS VARCHAR)", f"ltrim(replace(CAST(abs({x}) AS VARCHAR), '0.', ''), '0')"
    power = f"length({text}) - 1 - length({digits})"
    plain = f"{digits}[1] || '.' || CASE WHEN length({digits}) > 1 THEN {digits}[2:] ELSE '0' END || 'E-' || ({power})"
    whole = f"CASE WHEN contains({text}, '.') THEN '' ELSE '.0' END"
    short = f"split_part({text}, 'e', 1) || {whole} || 'E-' || CAST(split_part({text}, 'e-', 2) AS INTEGER)"
    small = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || CASE WHEN contains({text}, 'e') THEN {short} ELSE {plain} END"
    return f"CASE WHEN {x} = 0 OR abs({x}) >= 0.001 THEN CAST({x} AS VARCHAR) ELSE {small} END"


def member(key: str, column: str) -> str:
    if column in ("api_city", "country"):
        return f"""'"{key}":"' || {column} || '"'"""
    return f"""'"{key}":' || {written(column)}"""


PAYLOAD_TEXT = f"""'{{' || concat_ws(',', '"ts":' || {EPOCH}, {', '.join(member(k, c) for k, c in PAYLOAD_KEYS.items())},
  '"weather":{{"code":' || CAST(weather_code AS VARCHAR) || ',"description":"' || weather_description || '","icon":"c01d"}}',
  '"place_name":"' || place || '"') || '}}'"""

AS_LANDED = f"""SELECT * REPLACE (
    {observation_id('weatherbit', 'latitude', 'longitude', EPOCH)} AS id,
    'weatherbit_current' AS source, {BATCH} AS ingested_at)
  FROM obs"""
LANDED = f"""
landed AS (
  {AS_LANDED}
)"""
# Of dirty documents those that come through; see the proxy for the others.
DIRTY = f"""
dirty AS (
  {AS_LANDED} WHERE CAST(obs.id AS BIGINT) % 10 IN (3, 9)
),
shapes AS (
  SELECT COUNT(*) FILTER (event_id % 10 = 0) AS broken, COUNT(*) FILTER (event_id % 10 = 1) AS listed,
    COUNT(*) FILTER (event_id % 10 = 2) AS busy, COUNT(*) FILTER (event_id % 10 = 3) AS mixed,
    COUNT(*) FILTER (event_id % 10 = 4) AS unplaced, COUNT(*) FILTER (event_id % 10 IN (5, 6, 8)) AS untimed,
    COUNT(*) FILTER (event_id % 10 = 9) AS sound
  FROM events
)"""

EARLY = "\nearly AS (SELECT * FROM landed WHERE observed_at < TIMESTAMP '2024-01-16 12:00:00')"


def bins(value: str, edges: list[str], labels: list[str]) -> str:
    cases = " ".join(
        f"WHEN {value} > {lo} AND {value} <= {hi} THEN '{label}'"
        for lo, hi, label in zip(edges, edges[1:], labels, strict=False)
    )
    return f"CASE {cases} END"


# Edges and labels of the two categories.
WIND = bins(
    "wind_speed",
    ["-0.1", "0.2", "1.5", "3.3", "5.5", "7.9", "10.7", "13.8"],
    ["Calm", "Light air", "Light breeze", "Gentle breeze", "Moderate breeze", "Fresh breeze", "Strong breeze"],
)
UV = bins("uv_index", ["-0.1", "2", "5", "7", "10", "15"], ["Low", "Moderate", "High", "Very High", "Extreme"])

FEATURES = f"""CAST(hour(observed_at) AS INTEGER) AS observation_hour, dayname(observed_at) AS day_of_week,
    CAST(month(observed_at) AS INTEGER) AS month, {WIND} AS wind_category, {UV} AS uv_category"""


def silver(source: str = "obs") -> str:
    return f"""
kept AS (
  SELECT DISTINCT ON (place, date_trunc('hour', observed_at)) * FROM {source}
  WHERE observed_at IS NOT NULL AND place IS NOT NULL
  ORDER BY place, date_trunc('hour', observed_at), observed_at, ingested_at DESC NULLS LAST, id NULLS LAST
),
silver AS (SELECT {OBSERVATION_NAMES}, {FEATURES} FROM kept)"""


NULL_KEY = "'_dbt_utils_surrogate_key_null_'"
WEATHER_KEY = (
    f"md5(coalesce(CAST(weather_code AS VARCHAR), {NULL_KEY}) || '-' || coalesce(weather_description, {NULL_KEY}))"
)


def dim_date(source: str, ts: str) -> str:
    return f"""
days AS (SELECT {ts}::DATE AS full_date FROM {source} GROUP BY 1),
dim_date AS (
  SELECT (year(full_date) * 10000 + month(full_date) * 100 + day(full_date))::INTEGER AS date_key, full_date,
    year(full_date)::BIGINT AS year, quarter(full_date)::BIGINT AS quarter, month(full_date)::BIGINT AS month,
    monthname(full_date) AS month_name, day(full_date)::BIGINT AS day,
    dayofweek(full_date)::BIGINT AS day_of_week_sun_0, dayname(full_date) AS day_name,
    dayname(full_date) IN ('Saturday', 'Sunday') AS is_weekend
  FROM days
)"""


def dims(source: str = "silver") -> str:
    return f"""
latest AS (
  SELECT DISTINCT ON (place) place, api_city, country, latitude, longitude FROM {source} WHERE place IS NOT NULL
  ORDER BY place, ingested_at DESC NULLS LAST, observed_at DESC NULLS LAST, id
),
dim_location AS (SELECT md5(place) AS location_key, * FROM latest),
{dim_date(source, 'observed_at')},
pairs AS (SELECT weather_code, weather_description FROM {source} GROUP BY ALL),
dim_weather AS (SELECT {WEATHER_KEY} AS weather_key, * FROM pairs)"""


def exact_mean(x: str, scale: int) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE) / nullif(COUNT({x}), 0)"


def exact_sum(x: str, scale: int) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def fact(source: str = "silver", scale: int | None = None) -> str:
    """Each row looks its keys up; a missing match leaves null. The columns and their order are the table's (fixed values)."""
    avg = (lambda x: f"AVG({x})") if scale is None else (lambda x: exact_mean(x, scale))
    total = (lambda x: f"SUM({x})") if scale is None else (lambda x: exact_sum(x, scale))
    return f"""
keyed AS (
  SELECT s.*,
    (SELECT x.location_key FROM dim_location x WHERE x.place = s.place) AS location_key,
    (SELECT x.date_key FROM dim_date x WHERE x.full_date = s.observed_at::DATE) AS date_key,
    (SELECT x.weather_key FROM dim_weather x
      WHERE x.weather_code = s.weather_code AND x.weather_description = s.weather_description) AS weather_key
  FROM {source} s
),
fact AS (
  SELECT location_key, date_key, weather_key, observation_hour,
    {avg('temperature')} AS avg_temperature_celsius, {avg('apparent_temperature')} AS avg_feels_like_celsius,
    {avg('humidity')} AS avg_humidity_percent, MAX(wind_speed) AS max_wind_speed_ms,
    {avg('cloud_cover')} AS avg_cloud_coverage_percent, {total('precipitation')} AS total_precipitation_mmh,
    COUNT(id) AS observation_count
  FROM keyed GROUP BY location_key, date_key, weather_key, observation_hour
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def gold(gaps: bool = False) -> str:
    return with_(obs(gaps), silver(), dims(), fact())


LABELLED = """(SELECT * FROM fact LEFT JOIN dim_location USING (location_key) LEFT JOIN dim_date USING (date_key)
  LEFT JOIN dim_weather USING (weather_key))"""


def by_place(value: str, order: str) -> str:
    return f"""{gold()}SELECT place, {value} AS value FROM {LABELLED}
GROUP BY place ORDER BY value {order} NULLS LAST, place ASC NULLS LAST LIMIT 5"""


# The titles of the detail table, in its order, are in this query.
def detail(where: str, gaps: bool) -> str:
    return f"""{gold(gaps)}, newest AS (
  SELECT * FROM {LABELLED} WHERE {where}
  ORDER BY full_date DESC NULLS LAST, observation_hour DESC NULLS LAST, place NULLS LAST,
    weather_description NULLS LAST, location_key NULLS LAST, weather_key NULLS LAST LIMIT 200)
SELECT full_date AS "Date", observation_hour AS "Hour", place AS "Location",
  ROUND(avg_temperature_celsius, 1) AS "Temperature (°C)", weather_description AS "Weather Description",
  observation_count AS "Observation Count" FROM newest"""


def trend(hours: int, unit: str) -> str:
    return f"""{with_(obs(), silver())}SELECT CAST(date_trunc('{unit}', observed_at) AS TIMESTAMP) AS period,
  {exact_mean('temperature', 3)} AS avg_temperature, {exact_mean('humidity', 3)} AS avg_humidity
FROM silver WHERE observed_at > (SELECT MAX(observed_at) FROM silver) - INTERVAL {hours} HOUR GROUP BY 1"""


def percentile_value(rows: str, p: float) -> str:
    """Linear interpolation over `rows`, which has v, its zero-based rank r, and the row count n."""
    position = f"(CAST({p} AS DOUBLE) * (n - 1))"
    low = f"max(v) FILTER (WHERE r = floor({position}))"
    high = f"max(v) FILTER (WHERE r = ceil({position}))"
    t = f"max({position} - floor({position}))"
    return (
        f"(SELECT CASE WHEN {t} < 0.5 THEN {low} + ({high} - {low}) * {t} "
        f"ELSE {high} - ({high} - {low}) * (1 - {t}) END FROM {rows})"
    )


def ranked_values(name: str, value: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT {value} AS v, row_number() OVER (ORDER BY {value}) - 1 AS r, count(*) OVER () AS n
  FROM {source} WHERE {value} IS NOT NULL
)"""


def distinct_counts(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS n_unique FROM {table}" for c in columns
    )


LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]

SPARK_TYPES = {"VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp", "INTEGER": "int"}


def silver_info() -> str:
    derived = [("observation_hour", "INTEGER"), ("day_of_week", "VARCHAR"), ("month", "INTEGER"),
               ("wind_category", "VARCHAR"), ("uv_category", "VARCHAR")]
    parts = [
        f"SELECT '{n}' AS \"column\", COUNT({n}) AS non_null, '{SPARK_TYPES[t]}' AS type FROM silver"
        for n, t in SILVER_COLUMNS + derived
    ]
    return with_(obs(), silver()) + " UNION ALL ".join(parts)


def dq(test: str, table: str, column: str, failures: str) -> str:
    return (
        f"SELECT '{test}' AS test, '{table}' AS \"table\", '{column}' AS \"column\", "
        f"CAST(({failures}) AS BIGINT) AS failures"
    )


def dq_summary() -> str:
    real = {"fact_hourly_weather": "fact"}
    parts = []
    for table, column in [("dim_location", "location_key"), ("dim_location", "place"), ("dim_date", "date_key"),
                          ("dim_date", "full_date"), ("dim_weather", "weather_key")]:
        parts.append(dq("unique", table, column,
                        f"SELECT COUNT(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
                        f"GROUP BY {column} HAVING COUNT(*) > 1)"))  # fmt: skip
    for table, column in [
        ("dim_location", "location_key"), ("dim_location", "place"), ("dim_date", "date_key"),
        ("dim_date", "full_date"), ("dim_weather", "weather_key"), ("dim_weather", "weather_code"),
        ("dim_weather", "weather_description"), ("fact_hourly_weather", "location_key"),
        ("fact_hourly_weather", "date_key"), ("fact_hourly_weather", "weather_key"),
        ("fact_hourly_weather", "observation_count"),
    ]:
        parts.append(dq("not_null", table, column,
                        f"SELECT COUNT(*) FROM {real.get(table, table)} WHERE {column} IS NULL"))
    for column, parent in [("location_key", "dim_location"), ("date_key", "dim_date"), ("weather_key", "dim_weather")]:
        parts.append(dq("relationships", "fact_hourly_weather", column,
                        f"SELECT COUNT(*) FROM fact f WHERE f.{column} IS NOT NULL AND NOT EXISTS "
                        f"(SELECT 1 FROM {parent} p WHERE p.{column} = f.{column})"))  # fmt: skip
    for column, outside in [("observation_hour", "NOT BETWEEN 0 AND 23"),
                            ("avg_temperature_celsius", "NOT BETWEEN -80 AND 80"),
                            ("observation_count", "< 1")]:
        parts.append(dq("accepted_range", "fact_hourly_weather", column,
                        f"SELECT COUNT(*) FROM fact WHERE {column} {outside}"))
    return gold(gaps=True) + " UNION ALL ".join(parts)


ITEMS = """
items AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, p_brand AS place, l_shipdate + to_hours(l_linenumber) AS observed_at,
    l_shipdate + to_hours(l_linenumber) AS ingested_at, CAST(NULL AS VARCHAR) AS api_city,
    CAST(NULL AS VARCHAR) AS country, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    l_quantity AS temperature, l_discount AS apparent_temperature, l_tax AS humidity, l_extendedprice AS wind_speed,
    p_retailprice AS cloud_cover, l_quantity AS precipitation, CAST(p_size AS DOUBLE) AS weather_code,
    p_type AS weather_description, CAST(hour(l_shipdate + to_hours(l_linenumber)) AS INTEGER) AS observation_hour
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

CLEAN = r"regexp_replace(regexp_replace(trim({}), '(?i)^tỉnh\s+', ''), '(?i)^thành phố\s+', 'Thành phố ')"

COORDINATES = """CAST(8.5 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.61 AS DOUBLE) AS latitude,
    CAST(102.1 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.37 AS DOUBLE) AS longitude"""

GEOCODED = f"""WITH c AS (SELECT n_name AS name, n_name || ', Việt Nam' AS query, n_nationkey, {COORDINATES} FROM nation),
g AS (SELECT name, query, CASE WHEN n_nationkey % 3 = 0 THEN latitude END AS latitude,
  CASE WHEN n_nationkey % 3 = 0 THEN longitude END AS longitude FROM c)
"""

FACT_COLUMNS = "SELECT * FROM fact"

BACKFILLED = f"""SELECT {observation_id('weatherbit_historical', 'latitude', 'longitude', EPOCH)} AS observation_id,
  'weatherbit_historical' AS source, latitude AS lat, longitude AS lon, DATE '2024-02-01' AS ingest_date FROM obs"""

CURRENT = f"""SELECT {observation_id('weatherbit', 'latitude', 'longitude', EPOCH)} AS observation_id,
  'weatherbit_current' AS source, latitude AS lat, longitude AS lon, DATE '2024-02-01' AS ingest_date FROM obs"""

WEEK = "(PARTITION BY place ORDER BY epoch RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING)"
PAST_WEEK = (
    f"CAST(SUM(CAST(temperature AS DECIMAL(18,3))) OVER {WEEK} AS DOUBLE) / nullif(COUNT(temperature) OVER {WEEK}, 0)"
)

ORACLE: dict[str, str] = {
    "location_scan": f"SELECT n_name AS name, {COORDINATES} FROM nation",
    "boundary_scan": "SELECT n_name AS tenhc FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'",
    "province_names": "SELECT DISTINCT r_name AS name FROM region JOIN nation ON n_regionkey = r_regionkey",
    "clean_names": f"""SELECT {CLEAN.format('name')} AS name FROM (
  SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN 'tỉnh ' WHEN 1 THEN '  TỈNH  ' WHEN 2 THEN 'thành phố '
    ELSE 'THÀNH PHỐ   ' END || c_mktsegment || '  ' AS name FROM customer)""",
    "geocode_attach": GEOCODED + "SELECT name, query, latitude, longitude FROM g",
    "geocode_failures": GEOCODED + "SELECT COUNT(*) FILTER (WHERE latitude IS NULL) AS failed FROM g",
    "response_intake": f"""{with_(obs())}
SELECT place AS place_name, {EPOCH} + shift AS ts, temperature AS temp, api_city AS city_name
FROM obs, (VALUES (0), (1800)) s(shift)
WHERE weather_description NOT IN ('error', 'signup') AND (shift = 0 OR weather_description = 'purchase')""",
    "metadata_merge": """SELECT 'SUPPLIER_' || (l_suppkey % 25) AS place_name, o_orderkey AS "order",
  CAST(l_linenumber AS INTEGER) AS line, l_quantity AS temp, CASE WHEN l_tax = 0 THEN NULL ELSE o_orderstatus END AS status,
  CASE WHEN l_tax = 0 OR l_returnflag = 'R' THEN l_extendedprice END AS gust, o_totalprice AS aqi,
  true AS has_status, false AS has_old_gust, true AS has_app_temp
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "observation_id": f"""SELECT event_id, {observation_id(
        'weatherbit', '(value / CAST(7 AS DOUBLE))', '(value / CAST(-1000 AS DOUBLE))', 'CAST(floor(epoch(ts)) AS BIGINT)'
    )} AS observation_id FROM events""",
    "bronze_envelope": f"""{with_(obs())}
SELECT observation_id, source, lat, lon, {BATCH} AS _ingested_at, ingest_date, place_name, ts, raw_payload FROM (
  {CURRENT.replace(' FROM obs', f', place AS place_name, {EPOCH} AS ts, {PAYLOAD_TEXT} AS raw_payload FROM obs')}
  UNION ALL
  {BACKFILLED.replace(' FROM obs', f', place AS place_name, {EPOCH} AS ts, NULL AS raw_payload FROM obs')})""",
    "json_flatten": f"{with_(obs(), LANDED)}SELECT {OBSERVATION_NAMES} FROM landed",
    "silver_full": f"{with_(obs(), LANDED, silver('landed'))}SELECT * FROM silver",
    "epoch_to_ts": "SELECT event_id, date_trunc('second', ts) AS observed_at FROM events WHERE event_type <> 'error'",
    "silver_dedupe": f"{with_(obs(), silver())}SELECT id, place, observed_at, ingested_at FROM silver",
    "silver_typed": f"{with_(obs(), silver())}SELECT * FROM silver",
    "time_features": f"""{with_(obs())}SELECT id, CAST(hour(observed_at) AS INTEGER) AS observation_hour,
  dayname(observed_at) AS day_of_week, CAST(month(observed_at) AS INTEGER) AS month FROM obs""",
    "wind_category": f"{with_(obs())}SELECT id, {WIND} AS wind_category FROM obs",
    "uv_category": f"{with_(obs())}SELECT id, {UV} AS uv_category FROM obs",
    "stage_counts": f"""{with_(obs(), silver())}SELECT (SELECT COUNT(*) FROM obs) AS rows_read,
  (SELECT COUNT(*) FROM obs) - (SELECT COUNT(*) FROM silver) AS rows_removed,
  (SELECT COUNT(*) FROM silver) AS rows_written""",
    "dim_location": f"{with_(obs(), silver(), dims())}SELECT * FROM dim_location",
    "dim_date": f"{with_(obs(), silver(), dims())}SELECT * FROM dim_date",
    "dim_date_orders": f"{with_(dim_date('orders', 'o_orderdate'))}SELECT * FROM dim_date",
    "dim_weather": f"{with_(obs(True), silver(), dims())}SELECT * FROM dim_weather",
    "fact_hourly": gold(gaps=True) + FACT_COLUMNS,
    "fact_hourly_keyed": gold(gaps=True) + FACT_COLUMNS,
    "fact_at_scale": f"{with_(ITEMS, dims('items'), fact('items', 2))}{FACT_COLUMNS}",
    "kpi_total_locations": gold() + "SELECT COUNT(*) AS total_locations FROM dim_location",
    "kpi_average_temperature": gold()
    + f"SELECT {exact_mean('avg_temperature_celsius', 3)} AS average_temperature FROM fact",
    "kpi_average_humidity": gold() + f"SELECT {exact_mean('avg_humidity_percent', 3)} AS average_humidity FROM fact",
    "kpi_average_cloud_coverage": gold()
    + f"SELECT {exact_mean('avg_cloud_coverage_percent', 3)} AS average_cloud_coverage FROM fact",
    "kpi_highest_wind": gold() + "SELECT MAX(max_wind_speed_ms) AS highest_wind FROM fact",
    "kpi_filtered": gold()
    + f"""SELECT {exact_mean('avg_temperature_celsius', 3)} AS average_temperature FROM {LABELLED}
WHERE full_date BETWEEN {FILTER_DATES} AND place IN {FILTER_PLACES}""",
    "daily_trend": gold()
    + f"""SELECT full_date, {exact_mean('avg_temperature_celsius', 3)} AS avg_temperature,
  {exact_sum('total_precipitation_mmh', 3)} AS total_precipitation FROM {LABELLED} GROUP BY full_date""",
    "location_map": gold() + "SELECT place, latitude, longitude FROM dim_location",
    "top5_highest_temperature": by_place(exact_mean("avg_temperature_celsius", 3), "DESC"),
    "bottom5_lowest_temperature": by_place(exact_mean("avg_temperature_celsius", 3), "ASC"),
    "top5_most_humid": by_place(exact_mean("avg_humidity_percent", 3), "DESC"),
    "bottom5_least_humid": by_place(exact_mean("avg_humidity_percent", 3), "ASC"),
    "top5_strongest_wind": by_place("MAX(max_wind_speed_ms)", "DESC"),
    "bottom5_weakest_wind": by_place("MAX(max_wind_speed_ms)", "ASC"),
    "weather_distribution": gold()
    + f"""SELECT place, weather_description,
  CAST(SUM(observation_count) AS BIGINT) AS observation_count,
  CAST(SUM(observation_count) AS DOUBLE)
    / CAST(SUM(SUM(observation_count)) OVER (PARTITION BY place) AS DOUBLE) AS share
FROM {LABELLED} GROUP BY place, weather_description""",
    "detail_table": detail("true", gaps=True),
    "detail_stored": detail("true", gaps=True),
    "detail_filtered": detail(f"full_date BETWEEN {FILTER_DATES} AND place IN {FILTER_PLACES}", gaps=False),
    "last_24h_trend": trend(24, "hour"),
    "last_24h_partitions": trend(24, "hour"),
    "last_7d_trend": trend(168, "day"),
    "vs_7day_avg": f"""{with_(obs(), silver())}SELECT id, place, observed_at, temperature, week_avg,
  temperature - week_avg AS difference FROM (
  SELECT *, {PAST_WEEK} AS week_avg FROM (SELECT *, {EPOCH} AS epoch FROM silver))""",
    "current_extremes": f"""{with_(obs(), silver())}, latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY observed_at DESC, id) AS rn FROM silver)
  WHERE rn = 1)
SELECT * FROM (SELECT 'hottest' AS extreme, place, temperature AS value FROM latest ORDER BY value DESC, place LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'coldest', place, temperature AS value FROM latest ORDER BY value, place LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'windiest', place, wind_speed AS value FROM latest ORDER BY value DESC, place LIMIT 1)""",
    "coverage": f"""{with_(obs(), silver())}, hours AS (SELECT place, date_trunc('hour', observed_at) AS h FROM silver),
span AS (SELECT date_diff('hour', MIN(h), MAX(h)) + 1 AS expected FROM hours)
SELECT n_name AS place, COUNT(DISTINCT h) AS hours, CAST(expected AS BIGINT) AS expected,
  CAST(COUNT(DISTINCT h) AS DOUBLE) / CAST(expected AS DOUBLE) AS ratio
FROM span, nation LEFT JOIN hours ON n_name = place GROUP BY n_name, expected""",
    "missing_hours": f"""{with_(obs(), silver())}, hours AS (SELECT place, date_trunc('hour', observed_at) AS h FROM silver),
grid AS (SELECT n_name AS place, unnest(generate_series((SELECT MIN(h) FROM hours), (SELECT MAX(h) FROM hours),
  INTERVAL 1 HOUR)) AS hour FROM nation)
SELECT place, CAST(hour AS TIMESTAMP) AS hour FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM hours x WHERE x.place = g.place AND x.h = g.hour)""",
    "condition_frequency": gold()
    + f"""SELECT weather_description, CAST(SUM(observation_count) AS BIGINT) AS observation_count,
  CAST(SUM(observation_count) AS DOUBLE) / CAST((SELECT SUM(observation_count) FROM fact) AS DOUBLE) AS share
FROM {LABELLED} GROUP BY weather_description""",
    "dq_unique": """SELECT o_custkey, COUNT(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey HAVING COUNT(*) > 1""",
    "dq_not_null": "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders WHERE o_orderstatus = 'P'",
    "dq_relationships": """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS
(SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')""",
    "dq_accepted_range": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity < 2 OR l_quantity > 45""",
    "dq_summary": dq_summary(),
    "profile_distinct": distinct_counts("lineitem", LINEITEM),
    "profile_info": silver_info(),
    "profile_describe": f"""{with_(obs(), ranked_values('r', 'wind_speed', 'obs'))}, base AS (
  SELECT CAST(COUNT(wind_speed) AS DOUBLE) AS n, {exact_sum('wind_speed', 3)} AS s,
    CAST(SUM(CAST(CAST(wind_speed AS DECIMAL(18,3)) * CAST(wind_speed AS DECIMAL(18,3)) AS DECIMAL(36,6))) AS DOUBLE) AS q,
    MIN(wind_speed) AS lo, MAX(wind_speed) AS hi FROM obs)
SELECT 'count' AS statistic, n AS value FROM base UNION ALL SELECT 'mean', s / n FROM base
UNION ALL SELECT 'std', sqrt((q - s * s / n) / (n - 1)) FROM base UNION ALL SELECT 'min', lo FROM base
UNION ALL SELECT '25%', {percentile_value('r', 0.25)} UNION ALL SELECT '50%', {percentile_value('r', 0.5)}
UNION ALL SELECT '75%', {percentile_value('r', 0.75)} UNION ALL SELECT 'max', hi FROM base""",
    "profile_describe_items": f"""{with_(ranked_values('r', 'l_extendedprice', 'lineitem'))}
SELECT {percentile_value('r', 0.25)} AS p25, {percentile_value('r', 0.5)} AS p50, {percentile_value('r', 0.75)} AS p75""",
    "preview": f"{with_(obs())}SELECT id, place, observed_at FROM obs ORDER BY observed_at, id LIMIT 5",
    "roundtrip_partitioned": f"{with_(obs(), silver())}SELECT * FROM silver",
    "silver_dates": f"""{with_(obs(), silver())}SELECT id, place, observed_at FROM silver
WHERE CAST(observed_at AS DATE) IN (DATE '2024-01-08', DATE '2024-01-14')""",
    "schema_merge": f"""{with_(obs())}
SELECT observation_id, source, CAST(NULL AS VARCHAR) AS station, ingest_date FROM ({CURRENT})
UNION ALL SELECT observation_id, source, station, ingest_date + 1 FROM (
  {BACKFILLED.replace(' FROM obs', ', api_city AS station FROM obs')})""",
    "full_run": f"{with_(obs(), LANDED, silver('landed'), dims(), fact())}{FACT_COLUMNS}",
    "backfill_range": f"{with_(obs())}{BACKFILLED} WHERE CAST(observed_at AS DATE) BETWEEN {FILTER_DATES}",
    "publish_swap": gold() + FACT_COLUMNS,
    "stream_intake": f"{with_(obs())}{CURRENT}",
    "stream_dedupe": f"""{with_(obs(), silver())}SELECT * EXCLUDE (observation_hour, day_of_week, month, wind_category, uv_category)
FROM silver""",
    "stream_hourly": f"""{with_(obs())}SELECT date_trunc('hour', observed_at) AS hour_start, place, weather_code,
  weather_description, {exact_mean('temperature', 3)} AS avg_temperature_celsius,
  {exact_mean('apparent_temperature', 3)} AS avg_feels_like_celsius, {exact_mean('humidity', 3)} AS avg_humidity_percent,
  MAX(wind_speed) AS max_wind_speed_ms, {exact_mean('cloud_cover', 3)} AS avg_cloud_coverage_percent,
  {exact_sum('precipitation', 3)} AS total_precipitation_mmh, COUNT(id) AS observation_count FROM obs
GROUP BY 1, 2, 3, 4""",
    "incremental_merge": f"{with_(obs(), silver())}SELECT * FROM silver",
    "incremental_run": f"{with_(obs(), LANDED, silver('landed'), dims(), fact())}{FACT_COLUMNS}",
    "incremental_fact": gold() + FACT_COLUMNS,
    "run_twice": f"{with_(obs())}{CURRENT}",
    "stream_two_feeds": f"""{with_(obs())}{CURRENT} UNION ALL {BACKFILLED}
UNION ALL {BACKFILLED} WHERE CAST(observed_at AS DATE) BETWEEN {FILTER_DATES}""",
    "rejects": f"""{with_(obs(), DIRTY, silver('dirty'))}SELECT * FROM (
  SELECT 'bronze' AS stage, unnest(['body_not_json', 'body_not_object', 'data_not_array', 'element_not_object', 'accepted']) AS reason,
    unnest([broken, listed, busy, 3 * mixed, mixed + unplaced + untimed + sound]) AS n FROM shapes
  UNION ALL
  SELECT 'silver', unnest(['no_place', 'unreadable_time', 'accepted', 'duplicate']),
    unnest([unplaced, untimed, (SELECT COUNT(*) FROM silver), mixed + sound - (SELECT COUNT(*) FROM silver)]) FROM shapes
) WHERE n > 0 OR reason IN ('accepted', 'duplicate')""",
    "silver_dirty": f"{with_(obs(), DIRTY, silver('dirty'))}SELECT * FROM silver",
    "live_stream": f"""{with_(obs(), silver(), dims(), fact('silver', 3))}SELECT fact.*, dim_location.* EXCLUDE (location_key),
  (SELECT COUNT(*) FROM dim_date) AS n_dim_date, (SELECT COUNT(*) FROM dim_weather) AS n_dim_weather
FROM fact LEFT JOIN dim_location USING (location_key)""",
    "live_gate": f"""{with_(obs(), LANDED, EARLY, silver('early'), dims(), fact())}{FACT_COLUMNS}""",
}
