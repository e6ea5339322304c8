"""Landed API responses: one JSON document per line, or per file, with the place it was asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from cirrolake.functions import jsonmap
from cirrolake.schemas import CORRUPT

OBSERVATION_MAP = "map<string,variant>"


def read_responses(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Landed documents as text in `body`; each carries its `place_name` at the top level."""
    text = spark.read.text(path, wholetext=whole_file)
    return _with_place(text)


def stream_responses(
    spark: SparkSession, path: str, whole_file: bool = False, max_files: int | None = None
) -> DataFrame:
    """The same as a stream in which each landed file is taken once."""
    reader: DataStreamReader = spark.readStream.option("wholetext", whole_file)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_place(reader.text(path))


def _with_place(text: DataFrame) -> DataFrame:
    return text.select(F.get_json_object("value", "$.place_name").alias("place_name"), F.col("value").alias("body"))


def _named(rows: DataFrame) -> DataFrame:
    """Observations under our place name and not the API's city; a missing name is a JSON null."""
    return rows.select(jsonmap.put(F.col("obs"), "place_name", F.col("place_name")).alias("obs"))


def current_observations(responses: DataFrame) -> DataFrame:
    """One row per object in the `data` of a current-conditions response; none when `data` is absent.

    Elements that are no objects are left out one by one; `rejected_elements` lists them.
    """
    return _named(_objects(_elements(responses)))


def _elements(responses: DataFrame) -> DataFrame:
    document = F.from_json("body", "data array<variant>")
    return responses.select("place_name", F.explode(document["data"]).alias("element"))


def _objects(elements: DataFrame) -> DataFrame:
    """The elements that are objects, as maps, with the other columns."""
    others = [c for c in elements.columns if c != "element"]
    maps = elements.select(*others, F.try_variant_get("element", "$", OBSERVATION_MAP).alias("obs"))
    return maps.where(F.col("obs").isNotNull())


def rejected_elements(responses: DataFrame) -> DataFrame:
    """(place_name, element): elements of `data` that are no objects, as JSON text, of either feed."""
    found = _elements(responses).where(F.try_variant_get("element", "$", OBSERVATION_MAP).isNull())
    return found.select("place_name", F.coalesce(F.to_json("element"), F.lit("null")).alias("element"))


def history_observations(responses: DataFrame) -> DataFrame:
    """One row per element of an hourly-history response, on top of the response's metadata.

    Bodies that are not JSON give no rows; `rejected_responses` lists them.
    """
    documents = responses.select("place_name", F.from_json("body", OBSERVATION_MAP).alias("doc"))
    data = F.try_variant_get(F.try_element_at("doc", F.lit("data")), "$", "array<variant>")
    found = documents.select("place_name", jsonmap.without(F.col("doc"), "data").alias("meta"), F.explode(data).alias("element"))
    rows = _objects(found)
    merged = rows.select("place_name", jsonmap.overlay(F.col("meta"), F.col("obs")).alias("obs"))
    return harmonise_history(_named(merged))


def harmonise_history(observations: DataFrame) -> DataFrame:
    """Give history rows the keys of current rows: `wind_gust_spd` becomes `gust`; absent `app_temp`, `aqi` are null."""
    renamed = observations.select(jsonmap.rename_key(F.col("obs"), "wind_gust_spd", "gust").alias("obs"))
    return renamed.select(jsonmap.put_nulls(F.col("obs"), "app_temp", "aqi").alias("obs"))


# Why a landed document, or an element of its `data`, gives no observation.
NOT_JSON, NOT_OBJECT = "body_not_json", "body_not_object"
NOT_ARRAY, ELEMENT_NOT_OBJECT = "data_not_array", "element_not_object"


ID_PARTS = ["lat", "lon", "ts"]


def classified(responses: DataFrame, feed: str = "current", seconds: tuple[float, float] | None = None) -> DataFrame:
    """Every observation of landed documents, and beside them what cannot be one; one parse gives both.

    `reason` is null for observations; else `rejected` is the body, or the element's JSON. A document without `data`, or
    with an empty or null one, gives nothing: there is nothing wrong with it. Of history responses the observations are
    the maps `obs` of `history_observations`; of current ones `payload` is the element's own JSON with our place name at
    its end, and `lat`, `lon`, `ts` are the texts of its values. History observations may be kept to those whose `ts`
    lies in `seconds` [low, high); the rest is kept whatever its time.
    """
    return _classified_current(responses) if feed == "current" else _classified_history(responses, seconds)


def _why(json: Column, document: Column, data: Column, elements: Column) -> Column:
    """Why a body gives no elements; null where nothing is wrong with it."""
    return (
        F.when(json.isNull(), NOT_JSON)
        .when(document.isNull(), NOT_OBJECT)
        .when(data.isNotNull() & ~F.is_variant_null(data) & elements.isNull(), NOT_ARRAY)
    )


def _classified_current(responses: DataFrame) -> DataFrame:
    """The body is parsed once for the place and the elements' texts.

    As texts an element that is a string cannot be told from others, so documents are parsed a second time where an
    element does not begin like an object, or a string does.
    """
    shape = f"place_name string, data array<string>, {CORRUPT} string"
    first = responses.select("body", F.from_json("body", shape, {"columnNameOfCorruptRecord": CORRUPT}).alias("doc"))
    doubtful = (
        F.col("doc").isNull()
        | F.col("doc")[CORRUPT].isNotNull()
        | F.exists(F.col("doc")["data"], lambda e: e.isNull() | ~e.startswith("{"))
        | F.col("body").rlike(r'[\[,]\s*"\s*\{')
    )
    opened = first.select("body", "doc", F.coalesce(doubtful, F.lit(False)).alias("doubtful"))
    json = F.when(F.col("doubtful"), F.try_parse_json("body"))
    again = opened.select("body", "doc", "doubtful", json.alias("json"))
    document = F.try_variant_get("json", "$", OBSERVATION_MAP)
    data = F.try_variant_get("json", "$.data", "variant")
    found = F.try_variant_get("json", "$.data", "array<variant>")
    judged = again.select(
        "body",
        F.col("doc")["place_name"].alias("place_name"),
        F.when(F.col("doubtful"), _why(F.col("json"), document, data, found)).alias("why"),
        F.when(F.col("doubtful"), F.transform(found, lambda e: F.coalesce(F.to_json(e), F.lit("null"))))
        .otherwise(F.col("doc")["data"])
        .alias("elements"),
    )
    units = F.when(F.col("why").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(F.col("elements"))
    rows = judged.select("place_name", "why", F.when(F.col("why").isNotNull(), F.col("body")).alias("body"), F.explode(units).alias("element"))
    is_object = F.col("element").startswith("{")
    reason = F.coalesce(F.col("why"), F.when(~is_object, ELEMENT_NOT_OBJECT))
    parts = F.from_json("element", ", ".join(f"{p} string" for p in ID_PARTS))
    kept = rows.select(
        F.when(is_object, _with_name(F.col("element"), F.col("place_name"))).alias("payload"),
        F.coalesce("body", F.when(~is_object, F.col("element"))).alias("rejected"),
        reason.alias("reason"),
        F.when(is_object, parts).alias("parts"),
    )
    return kept.select("payload", *[F.col("parts")[p].alias(p) for p in ID_PARTS], "rejected", "reason")


def _with_name(element: Column, place_name: Column) -> Column:
    """An object's text with `place_name` at its end; where it may have one already, through a map."""
    quoted = F.to_json(F.struct(place_name.alias("p")), {"ignoreNullFields": "false"})
    name = F.substr(quoted, F.lit(6), F.length(quoted) - 6)
    appended = F.concat(F.left(element, F.length(element) - 1), F.when(element != "{}", ",").otherwise(""), F.lit('"place_name":'), name, F.lit("}"))
    replaced = jsonmap.put(F.try_variant_get(F.try_parse_json(element), "$", OBSERVATION_MAP), "place_name", place_name)
    return F.when(element.contains('"place_name"'), F.to_json(replaced, {"ignoreNullFields": "false"})).otherwise(appended)


def _classified_history(responses: DataFrame, seconds: tuple[float, float] | None = None) -> DataFrame:
    parsed = responses.select("body", F.try_parse_json("body").alias("json"))
    documents = parsed.select("body", "json", F.try_variant_get("json", "$", OBSERVATION_MAP).alias("doc"))
    data = F.try_element_at("doc", F.lit("data"))
    elements = F.try_variant_get(data, "$", "array<variant>")
    judged = documents.select("body", "doc", elements.alias("elements"), _why(F.col("json"), F.col("doc"), data, elements).alias("why"))
    units = F.when(F.col("why").isNotNull(), F.array(F.lit(None).cast("variant"))).otherwise(F.col("elements"))
    found = judged.select(
        F.try_variant_get(F.try_element_at("doc", F.lit("place_name")), "$", "string").alias("place_name"),
        jsonmap.without(F.col("doc"), "data").alias("meta"),
        "why",
        F.when(F.col("why").isNotNull(), F.col("body")).alias("body"),
        F.explode(units).alias("element"),
    )
    maps = found.withColumn("obs", F.try_variant_get("element", "$", OBSERVATION_MAP))
    if seconds is not None:
        # The time of the merged map below, taken before merging: the element's `ts` wins over the metadata's.
        ts = F.when(F.map_contains_key("obs", F.lit("ts")), F.try_element_at("obs", F.lit("ts"))).otherwise(F.try_element_at("meta", F.lit("ts")))
        at = F.try_variant_get(ts, "$", "string").try_cast("double")
        maps = maps.where(F.col("why").isNotNull() | F.col("obs").isNull() | ((at >= seconds[0]) & (at < seconds[1])))
    reason = F.coalesce(F.col("why"), F.when(F.col("obs").isNull(), ELEMENT_NOT_OBJECT))
    rejected = F.coalesce("body", F.when(F.col("obs").isNull(), F.coalesce(F.to_json("element"), F.lit("null"))))
    merged = jsonmap.put(jsonmap.overlay(F.col("meta"), F.col("obs")), "place_name", F.col("place_name"))
    kept = maps.select(merged.alias("obs"), rejected.alias("rejected"), reason.alias("reason"))
    renamed = kept.withColumn("obs", jsonmap.rename_key(F.col("obs"), "wind_gust_spd", "gust"))
    return renamed.withColumn("obs", jsonmap.put_nulls(F.col("obs"), "app_temp", "aqi"))


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Responses whose body is not JSON."""
    return responses.where(F.try_parse_json("body").isNull())


def geocoded(responses: DataFrame) -> DataFrame:
    """Coordinates of the first hit per geocoder response; nulls when there is none or it cannot be read."""
    hits = F.from_json("body", "array<struct<lat: string, lon: string>>")
    first = F.get(hits, F.lit(0))
    return responses.select(
        "name",
        first["lat"].try_cast("double").alias("latitude"),
        first["lon"].try_cast("double").alias("longitude"),
    )
