"""Property tests: invariants that must hold for any input."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterline.functions.geo import haversine_km
from meterline.functions.hashing import sample_order_key
from meterline.operators import clean as C
from meterline.operators.funnel import funnel_counts
from meterline.operators.report import error_histogram
from meterline.operators.sample import ordered_sample
from meterline.schemas import RAW_TRIP_SCHEMA

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

lat = st.floats(-89.9, 89.9)
lon = st.floats(-179.9, 179.9)


@settings(**SETTINGS)
@given(st.lists(st.tuples(lat, lon, lat, lon), min_size=1, max_size=20))
def test_haversine_symmetric_and_matches_numpy(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    rows = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y")).collect()
    for (a, b, c, d), r in zip(pts, rows):
        p1, p2 = math.radians(a), math.radians(c)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
        want = 6371.0 * 2 * math.asin(math.sqrt(h))
        assert r.x >= 0 and abs(r.x - r.y) < 1e-6 and abs(r.x - want) < 1e-6


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 40), min_size=0, max_size=120), st.integers(1, 60))
def test_sample_exact_with_duplicates(spark, keys, n):
    df = spark.createDataFrame([(str(k), i) for i, k in enumerate(keys)], "key string, v int")
    fast = sorted(r.key for r in ordered_sample(df, n).collect())
    brute = sorted(r.key for r in df.orderBy(sample_order_key("key"), "key").limit(n).collect())
    assert fast == brute


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.floats(0, 1000), st.floats(0, 1000)), min_size=1, max_size=80))
def test_histogram_partitions_every_row(spark, pairs):
    df = spark.createDataFrame(pairs, "label double, prediction double")
    bins = error_histogram(df).collect()
    assert sum(b.n for b in bins) == len(pairs)
    assert all(0 <= b.bin <= 29 for b in bins)
    errs = [abs(a - b) for a, b in pairs]
    lo, hi = min(errs), max(errs)
    for b in bins:
        assert b.bin_lo >= lo - 1e-9 and b.bin_hi <= hi + 1e-6 * max(1.0, hi)


raw_row = st.fixed_dictionaries(
    {
        "key": st.one_of(st.none(), st.text("abc0123", min_size=1, max_size=4)),
        "fare_amount": st.one_of(st.none(), st.just(float("nan")), st.floats(-10, 400)),
        "pickup_datetime": st.one_of(st.none(), st.just("not a date"), st.just("2012-03-04 05:06:07 UTC")),
        "pickup_longitude": st.one_of(st.none(), st.floats(-76, -71)),
        "pickup_latitude": st.one_of(st.none(), st.floats(39.5, 42.5)),
        "dropoff_longitude": st.one_of(st.none(), st.floats(-76, -71)),
        "dropoff_latitude": st.one_of(st.none(), st.floats(39.5, 42.5)),
        "passenger_count": st.one_of(st.none(), st.integers(-1, 8)),
    }
)


@settings(**SETTINGS)
@given(st.lists(raw_row, min_size=1, max_size=40))
def test_funnel_monotone_and_equal_to_staged_filters(spark, rows):
    order = [f.name for f in RAW_TRIP_SCHEMA.fields]
    df = spark.createDataFrame([tuple(r[c] for c in order) for r in rows], RAW_TRIP_SCHEMA)
    counts = [r.rows for r in funnel_counts(df).orderBy("step").collect()]
    assert counts[0] == len(rows)
    assert all(a >= b for a, b in zip(counts, counts[1:]))
    staged = [v.count() for v in C.clean_stages(df).values()]
    assert counts == staged
    full = C.with_time_features(C.clean_stages(df)["after_distance_filter"]).na.drop(subset=C.FINAL_COMPLETE_COLUMNS)
    assert full.count() == counts[-1]
    assert all(r.fare_amount > 0 for r in C.clean_trips(df).select("fare_amount").collect())
