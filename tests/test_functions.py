import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from builders import values
from cirrolake.functions import calendar as cal
from cirrolake.functions.bins import uv_category, wind_category
from cirrolake.functions.keys import surrogate_key, with_observation_id, with_six_digits
from cirrolake.functions.measures import mean, total
from cirrolake.functions.text import clean_place_name, geocoder_query


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("tỉnh Quảng Ngãi", "Quảng Ngãi"),
        ("TỈNH Quảng Ngãi", "Quảng Ngãi"),
        ("Tỉnh   Quảng Ngãi  ", "Quảng Ngãi"),
        ("thành phố Huế", "Thành phố Huế"),
        ("THÀNH PHỐ  Huế", "Thành phố Huế"),
        (" tỉnh Lào Cai ", "Lào Cai"),
        ("Thủ đô Hà Nội", "Thủ đô Hà Nội"),
        ("Bình tỉnh Dương", "Bình tỉnh Dương"),
        ("tỉnh", "tỉnh"),
        (None, None),
    ],
)
def test_place_names(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "name string")
    assert df.select(clean_place_name(F.col("name"))).first()[0] == clean


def test_geocoder_query(spark):
    df = spark.createDataFrame([("Phường Trương Quang Trọng",)], "name string")
    row = df.select(geocoder_query(F.col("name")), geocoder_query(F.col("name"), "Quảng Ngãi")).first()
    assert tuple(row) == (
        "Phường Trương Quang Trọng, Việt Nam",
        "Phường Trương Quang Trọng, Quảng Ngãi, Việt Nam",
    )


def test_six_digits_like_python(spark):
    rng = random.Random(1)
    numbers = [0.0, -0.0, 21.0, 105.789, 10.12345, 2.000005, 99.99996, 100.0005, 0.5, 0.00001234, 0.0001, 0.00065, 179.9995]
    numbers += [round(rng.uniform(-180, 180), d) for d in range(9) for _ in range(300)]
    # Ties: seven significant digits that end in five.
    numbers += [rng.randrange(10**5, 10**6) / 10**4 + 5 / 10**5 for _ in range(500)]
    numbers += [rng.uniform(-1, 1) * 10 ** -rng.randrange(6) for _ in range(500)]
    df = spark.createDataFrame([(float(x),) for x in numbers], "x double")
    wrong = [(r.x, r.t) for r in with_six_digits(df, {"t": "x"}).collect() if r.t != f"{r.x:.6}"]
    assert wrong == []


def test_observation_id(spark):
    rows = [(21.0283335, 105.854041, "1761800400"), (None, 1.0, "1"), (1.0, None, "1"), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "lat double, lon double, ts string")
    ids = [r.observation_id for r in with_observation_id(df, "weatherbit").collect()]
    assert ids[0] == hashlib.sha256(b"weatherbit|21.0283|105.854|1761800400").hexdigest()
    assert ids[1:] == [None, None, None]
    assert with_observation_id(df, "weatherbit").columns == ["lat", "lon", "ts", "observation_id"]


def test_equal_coordinates_give_equal_ids(spark):
    rows = [("ward 1", 15.1, 108.8, "5"), ("ward 2", 15.1, 108.8, "5")]
    df = spark.createDataFrame(rows, "place string, lat double, lon double, ts string")
    assert with_observation_id(df, "s").select("observation_id").distinct().count() == 1


def test_surrogate_key(spark):
    df = spark.createDataFrame([(804.0, "Clouds"), (None, "x"), (None, None)], "code double, text string")
    null = "_dbt_utils_surrogate_key_null_"
    keys = [r[0] for r in df.select(surrogate_key("code", "text")).collect()]
    assert keys == [hashlib.md5(t.encode()).hexdigest() for t in ("804.0-Clouds", f"{null}-x", f"{null}-{null}")]


def test_wind_bins(spark):
    cases = [(-0.1, None), (-0.05, "Calm"), (0.0, "Calm"), (0.2, "Calm"), (0.21, "Light air"), (1.5, "Light air"),
             (3.3, "Light breeze"), (5.5, "Gentle breeze"), (7.9, "Moderate breeze"), (10.7, "Fresh breeze"),
             (13.8, "Strong breeze"), (13.81, None), (None, None), (math.nan, None)]
    df = spark.createDataFrame([(v,) for v, _ in cases], "v double").coalesce(1)
    assert [r[0] for r in df.select(wind_category(F.col("v"))).collect()] == [label for _, label in cases]


def test_uv_bins(spark):
    cases = [(-0.1, None), (0.0, "Low"), (2.0, "Low"), (2.1, "Moderate"), (7.0, "High"), (10.0, "Very High"),
             (15.0, "Extreme"), (15.1, None)]
    df = spark.createDataFrame([(v,) for v, _ in cases], "v double").coalesce(1)
    assert [r[0] for r in df.select(uv_category(F.col("v"))).collect()] == [label for _, label in cases]


def test_weekend(spark):
    days = [(dt.date(2025, 11, 2),), (dt.date(2025, 11, 1),), (dt.date(2025, 10, 31),)]
    df = spark.createDataFrame(days, "d date").coalesce(1)
    got = df.select(cal.day_of_week_sun_0(F.col("d")), cal.is_weekend(F.col("d")), cal.date_key(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(0, True, 20251102), (6, True, 20251101), (5, False, 20251031)]


def test_epoch(spark):
    texts = ["1761800400", "1761800400.0", "1.7618004e9", " 1761800400 ", "soon", "", None, "1e300", "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] for r in df.select(F.unix_seconds(cal.epoch_to_timestamp(F.col("t")))).collect()]
    assert got == [1761800400] * 4 + [None] * 5


def test_exact_sums(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "v double")
    assert values(df.agg(total("v", 1), mean("v", 1))) == [(0.6, 0.6 / 3)]
    empty = df.where("v > 1")
    assert values(empty.agg(total("v"), total("v", 1), mean("v"), mean("v", 1))) == [(None,) * 4]
