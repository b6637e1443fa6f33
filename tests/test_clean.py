"""Cleaning rules on hand-written edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from meterline.functions.geo import haversine_km
from meterline.operators import clean as C
from meterline.operators.validate import MissingColumnsError, require_columns
from meterline.schemas import CLEAN_COLUMNS, RAW_TRIP_SCHEMA

NAN = float("nan")
GOOD = dict(
    key="k",
    fare_amount=10.0,
    pickup_datetime="2009-06-15 17:26:21 UTC",
    pickup_longitude=-73.99,
    pickup_latitude=40.75,
    dropoff_longitude=-73.95,
    dropoff_latitude=40.78,
    passenger_count=1,
)
ORDER = [f.name for f in RAW_TRIP_SCHEMA.fields]


def rows(*overrides):
    out = []
    for i, o in enumerate(overrides):
        r = {**GOOD, "key": f"k{i}", **o}
        out.append(tuple(r[c] for c in ORDER))
    return out


def kept_keys(spark, *overrides, stage="final"):
    df = spark.createDataFrame(rows(*overrides), RAW_TRIP_SCHEMA)
    return sorted(r["key"] for r in C.clean_stages(df)[stage].collect() if r["key"] is not None)


def test_fare_bounds(spark):
    keys = kept_keys(spark, {"fare_amount": 0.0}, {"fare_amount": 0.01}, {"fare_amount": 300.0}, {"fare_amount": 300.01})
    assert keys == ["k1", "k2"]


def test_passenger_bounds(spark):
    keys = kept_keys(spark, {"passenger_count": 0}, {"passenger_count": 1}, {"passenger_count": 6}, {"passenger_count": 7})
    assert keys == ["k1", "k2"]


def test_bbox_inclusive(spark):
    keys = kept_keys(
        spark,
        {"pickup_longitude": -75.0},
        {"dropoff_longitude": -72.0},
        {"dropoff_longitude": -71.99},
        {"pickup_latitude": 40.0},
        {"dropoff_latitude": 42.0},
        {"dropoff_latitude": 42.01},
        stage="after_domain_filter",
    )
    assert keys == ["k0", "k1", "k3", "k4"]


def test_zero_and_long_distance(spark):
    same = {"dropoff_longitude": GOOD["pickup_longitude"], "dropoff_latitude": GOOD["pickup_latitude"]}
    far = {"pickup_latitude": 40.1, "dropoff_latitude": 41.9}
    assert kept_keys(spark, same, far, {}) == ["k2"]


def test_nan_null_and_bad_date(spark):
    keys = kept_keys(
        spark,
        {"fare_amount": NAN},
        {"dropoff_longitude": None},
        {"pickup_datetime": "not a date"},
        {"key": None},
        {"pickup_datetime": None},
        {},
    )
    assert keys == ["k5"]


def test_null_key_dropped_only_at_final_stage(spark):
    df = spark.createDataFrame(rows({"key": None}, {}), RAW_TRIP_SCHEMA)
    stages = C.clean_stages(df)
    assert stages["after_distance_filter"].count() == 2
    assert stages["final"].count() == 1


def test_known_distance(spark):
    df = spark.createDataFrame([(40.721319, -73.844311, 40.712278, -73.84161), (None, -73.8, 40.7, -73.8)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(1.030764, abs=1e-6)
    assert got[1] is None


def test_time_features_and_schema(spark):
    df = spark.createDataFrame(rows({}), RAW_TRIP_SCHEMA)
    r = C.clean_trips(df).first()
    assert (r.pickup_hour, r.pickup_dayofweek, r.pickup_month, r.pickup_year) == (17, 2, 6, 2009)
    assert C.clean_trips(df).columns == CLEAN_COLUMNS


def test_timezone_does_not_change_features(spark):
    df = spark.createDataFrame(rows({}, {"pickup_datetime": "2016-12-31 23:59:59 UTC"}), RAW_TRIP_SCHEMA)
    before = C.clean_trips(df).orderBy("key").collect()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        after = C.clean_trips(df).orderBy("key").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after
    assert after[1].pickup_year == 2016 and after[1].pickup_hour == 23


def test_missing_columns_listed(spark):
    df = spark.createDataFrame(rows({}), RAW_TRIP_SCHEMA).drop("passenger_count", "fare_amount")
    with pytest.raises(MissingColumnsError) as e:
        C.clean_trips(df)
    assert e.value.missing == ["fare_amount", "passenger_count"]
    require_columns(df, ["key"])


def test_flags_agree_with_filters(spark):
    df = spark.createDataFrame(
        rows({"fare_amount": NAN}, {"passenger_count": 7}, {"dropoff_latitude": 40.75, "dropoff_longitude": -73.99}, {"key": None}, {}),
        RAW_TRIP_SCHEMA,
    )
    flags = C.with_stage_flags(df)
    stages = C.clean_stages(df)
    got = flags.agg(*[F.count_if(c).alias(c) for c in ["is_complete", "in_domain", "in_range", "is_final"]]).first()
    assert got.is_complete == stages["after_dropna"].count()
    assert got.in_domain == stages["after_domain_filter"].count()
    assert got.in_range == stages["after_distance_filter"].count()
    assert got.is_final == stages["final"].count()
    assert sorted(r.key for r in C.clean_from_flags(flags).collect()) == sorted(r.key for r in C.clean_trips(df).collect())
    assert not math.isnan(C.clean_trips(df).first().fare_amount)


def test_final_predicate_equals_full_dropna(spark):
    from meterline.sources.fixtures import read_raw_trips

    from .conftest import SF001

    df = read_raw_trips(spark, SF001).union(spark.createDataFrame(rows({"key": None}), RAW_TRIP_SCHEMA))
    stages = C.clean_stages(df)
    featured = C.with_time_features(stages["after_distance_filter"])
    full = featured.na.drop(subset=C.FINAL_COMPLETE_COLUMNS)
    assert sorted(map(tuple, full.select(*CLEAN_COLUMNS).collect()), key=str) == sorted(
        map(tuple, stages["final"].select(*CLEAN_COLUMNS).collect()), key=str
    )
    assert stages["final"].count() == 718 - 1


TIME_CASES = [
    "2009-06-15 17:26:21", "2009-02-30 10:00:00", "2012-02-29 00:00:00", "2011-02-29 00:00:00",
    "2009-06-15 24:00:00", "2009-6-15 17:26:21", "2009-06-15T17:26:21", "2009-06-15 17:26:21 ",
    " 2009-06-15 17:26:21", "2009-06-15 17:26:21.5", "2009-06-15", "2009-06-15 17:26", "0000-01-01 00:00:00",
    "9999-12-31 23:59:59", "2009-06-15 17:26:60", "2009-13-01 00:00:00", "not a date", "", None,
    "2010-03-14 02:30:00", "12009-06-15 17:26:21", "+2009-06-15 17:26:21", "2009/06/15 17:26:21",
]


def test_parse_accepts_exactly_the_pattern(spark):
    from meterline.functions.timeparts import PICKUP_FORMAT, parse_pickup_timestamp

    df = spark.createDataFrame([(c,) for c in TIME_CASES], "s string")
    out = df.select(
        F.date_format(F.try_to_timestamp("s", F.lit(PICKUP_FORMAT)), PICKUP_FORMAT).alias("a"),
        F.date_format(parse_pickup_timestamp("s"), PICKUP_FORMAT).alias("b"),
    ).collect()
    assert [r.a for r in out] == [r.b for r in out]


def test_dst_gap_keeps_wall_clock_hour(spark):
    df = spark.createDataFrame(rows({"pickup_datetime": "2010-03-14 02:30:00 UTC"}), RAW_TRIP_SCHEMA)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = C.clean_trips(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.pickup_hour, r.pickup_dayofweek, r.pickup_month, r.pickup_year) == (2, 1, 3, 2010)
