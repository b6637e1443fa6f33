"""As-of, interval and nearest joins against brute force, with nulls, ties, repeats and a hot key."""

import math
import random

import pytest

from __spark_entry__ import queries

from meterline.operators.asof import asof_join
from meterline.operators.interval import mean_width, overlap_join, point_in_range_join, range_totals
from meterline.operators.nearest import nearest_join


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ as-of


def brute_asof(left, right, strict):
    out = []
    for i, u, t in left:
        fits = [(x, v) for k, x, v in right if None not in (u, t, k, x) and k == u and (x < t if strict else x <= t)]
        best = max(fits, key=lambda r: (r[0], r[1] is not None, r[1] or "")) if fits else (None, None)
        out.append((i, u, t, *best))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("width", [None, 1, 7])
def test_asof_against_brute_force(spark, strict, width):
    rng = random.Random(1)
    # User 0 holds a third of all rows; times tie often.
    user = lambda: rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, None])
    time = lambda: rng.choice([None, *(rng.randrange(-30, 60) for _ in range(15))])
    left = [(i, user(), time()) for i in range(150)] + [(7, 0, 5), (7, 0, 5)]
    right = [(user(), time(), rng.choice([None, "a", "b", "c"])) for _ in range(150)]
    l_df, r_df = spark.createDataFrame(left, "i int, u int, t int"), spark.createDataFrame(right, "u int, t int, v string")
    got = asof_join(l_df, r_df, ["u"], "t", "t", strict=strict, width=width)
    assert got.columns == ["i", "u", "t", "right_t", "right_v"]
    assert rows_of(got) == brute_asof(left, right, strict)


def test_asof_buckets_spread_a_hot_user(spark):
    left = spark.range(5000).selectExpr("id AS i", "'u' AS u", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS t")
    right = left.filter("i % 100 = 3").selectExpr("u", "t", "i AS v")
    got = asof_join(left, right, ["u"], "t", "t", rows_per_bucket=200)
    assert "Join" not in plan_of(got)
    assert {(r.i, r.right_v) for r in got.select("i", "right_v").collect()} == {(i, (i - 3) // 100 * 100 + 3 if i >= 3 else None) for i in range(5000)}


def test_asof_empty_sides_and_clashes(spark):
    left = spark.createDataFrame([(1, 1, 2)], "i int, u int, t int")
    none = left.select("u", "t").limit(0)
    assert rows_of(asof_join(left, none, ["u"], "t", "t")) == [(1, 1, 2, None)]
    assert asof_join(left.limit(0), left.select("u", "t"), ["u"], "t", "t").count() == 0
    with pytest.raises(ValueError, match="clash"):
        asof_join(left.withColumnRenamed("i", "right_t"), left.select("u", "t"), ["u"], "t", "t")


# --------------------------------------------------------------- interval


def ranges(rng, n):
    def one(i):
        s = rng.randrange(-200, 200)
        return i, rng.choice([0, 0, 1, None]), rng.choice([None, s]) if i % 9 == 0 else s, s + rng.choice([0, 3, 10, 40, 300, -5])

    return [one(i) for i in range(n)]


@pytest.mark.parametrize("closed", [False, True])
def test_points_in_ranges_against_brute_force(spark, closed):
    rng = random.Random(2)
    points = [(i, rng.choice([0, 0, 1, None]), rng.choice([None, 17, 17, *range(-210, 520, 7)])) for i in range(200)]
    spans = ranges(rng, 120) + [(500, 0, 17, 17), (500, 0, 17, 17)]
    p, r = spark.createDataFrame(points, "i int, k int, at int"), spark.createDataFrame(spans, "i int, k int, s int, e int")
    inside = lambda at, s, e: None not in (at, s, e) and s <= at and (at <= e if closed else at < e)
    for width in (None, 1, 1000):
        got = point_in_range_join(p, r, "at", "s", "e", closed=closed, width=width)
        assert got.columns == ["i", "k", "at", "range_i", "range_k", "s", "e"]
        assert rows_of(got) == sorted(((*a, *b) for a in points for b in spans if inside(a[2], b[2], b[3])), key=str)
    keyed = point_in_range_join(p, r, "at", "s", "e", keys=["k"], closed=closed)
    assert rows_of(keyed) == sorted(((*a, b[0], b[2], b[3]) for a in points for b in spans if a[1] is not None and a[1] == b[1] and inside(a[2], b[2], b[3])), key=str)
    assert "NestedLoop" not in plan_of(keyed) and "Cartesian" not in plan_of(keyed)


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("rows_per_bucket", [1, 20, 1_000_000])
def test_range_totals_against_brute_force(spark, closed, rows_per_bucket):
    rng = random.Random(4)
    points = [(rng.choice([None, 17, 17, *range(-210, 320, 7)]), rng.choice([None, None, -5, 3, 2**40])) for _ in range(200)]
    spans = ranges(rng, 120) + [(500, 0, 17, 17), (500, 0, 17, 17), (501, 1, -900, -800), (502, None, 800, 900), (503, 1, -900, -210), (504, 0, 316, 900)]
    p, r = spark.createDataFrame(points, "at int, v long"), spark.createDataFrame(spans, "v int, k int, s int, e int")
    want = set()
    for span in spans:
        s, e = span[2:]
        held = [v for at, v in points if None not in (at, s, e) and s <= at and (at <= e if closed else at < e)]
        known = [v for v in held if v is not None]
        if held:
            want.add((*span, len(held), sum(known) if known else None))
    small = p.withColumnRenamed("v", "w")
    got = range_totals(small, r, "at", "s", "e", ["w"], closed=closed, rows_per_bucket=rows_per_bucket)
    assert got.columns == ["v", "k", "s", "e", "n_points", "w"]
    assert rows_of(got) == sorted(want, key=str)
    assert range_totals(small.limit(0), r, "at", "s", "e", ["w"]).count() == 0
    assert range_totals(small, r.limit(0), "at", "s", "e", ["w"]).count() == 0


def test_range_totals_beyond_a_long(spark):
    """The running totals pass a long's range, no range's own sum does."""
    p = spark.range(10).selectExpr("id AS at", "9000000000000000000L AS v")
    got = range_totals(p, spark.sql("SELECT 8L AS s, 8L AS e"), "at", "s", "e", ["v"], closed=True)
    assert rows_of(got) == [(8, 8, 1, 9 * 10**18)]
    with pytest.raises(TypeError, match="double"):
        range_totals(p.selectExpr("at", "1.5D AS v"), p, "at", "at", "at", ["v"])


def test_shipping_ranges_list_no_pairs(spark, tmp_path):
    """2,000 orders at times of their own in each of 300 suppliers' ranges: 600,000 pairs, of which none is made."""
    orders = spark.range(2000).selectExpr("timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id) AS o_orderdate", "id / 100D AS o_totalprice")
    days = "explode(array(timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-02-01 00:00:00')) AS l_shipdate"
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(300).selectExpr("id AS l_suppkey", "45D AS l_quantity", days).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries()["orders_in_shipping_ranges"](spark, str(tmp_path))
    assert rows_of(got) == sorted(((i, 2024 * 4 + 1, 2000, 1_999_000) for i in range(300)), key=str)
    made = rows_made(got)
    assert made and max(made) <= 2000


def rows_made(df):
    """Rows that come out of each join of the executed plan."""
    df.collect()
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.endswith("Join"):
            out.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_overlaps_of_a_table_with_itself(spark):
    spans = ranges(random.Random(3), 100)
    df = spark.createDataFrame(spans, "i int, k int, s int, e int")
    real = [r for r in spans if None not in r[2:] and r[2] <= r[3]]
    want = sorted(((*a, *b) for a in real for b in real if a[2] <= b[3] and b[2] <= a[3]), key=str)
    got = overlap_join(df, df, ("s", "e"), ("s", "e"))
    assert got.columns == ["i", "k", "s", "e", "other_i", "other_k", "other_s", "other_e"]
    assert rows_of(got) == want
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_bins_stay_linear_beside_one_endless_range(spark):
    df = spark.range(2000).selectExpr("id AS s", "id + 1 AS e").unionByName(spark.sql("SELECT 0L AS s, 1000000L AS e"))
    width = mean_width(df, "s", "e")
    assert 1_002_000 // width < 2 * 2001
    got = point_in_range_join(spark.sql("SELECT 999999L AS at"), df, "at", "s", "e")
    assert rows_of(got) == [(999999, 0, 1000000)]
    assert point_in_range_join(df.selectExpr("s AS at"), df.limit(0), "at", "s", "e").count() == 0


# ---------------------------------------------------------------- nearest


def km(a, b):
    p1, l1, p2, l2 = map(math.radians, (*a, *b))
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 6371 * 2 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("cell", [None, 0.01, 170.0])
def test_nearest_against_brute_force(spark, cell):
    rng = random.Random(4)
    town = lambda: (rng.gauss(40.7, 0.05), rng.gauss(-74, 0.05))
    far = lambda: (rng.choice([-90.0, 90.0, 0.0, rng.uniform(-90, 90)]), rng.choice([-180.0, 180.0, 179.99, rng.uniform(-180, 180)]))
    sites = [(i, *(town() if i % 4 else far())) for i in range(80)] + [(200, None, 1.0), (201, math.nan, 1.0), (None, 40.7, -74.0), (202, 95.0, 0.0)]
    sites += [(300, *sites[5][1:]), (2, *sites[2][1:])]
    points = [(i, *(town() if i % 3 else far())) for i in range(150)] + [(400, None, None), (401, math.nan, 0.0), (402, 40.7, -74.0), (402, 40.7, -74.0), (403, *sites[5][1:])]
    p, s = spark.createDataFrame(points, "i int, lat double, lon double"), spark.createDataFrame(sites, "sid int, la double, lo double")
    real = [r for r in sites if None not in r and not any(map(math.isnan, r)) and abs(r[1]) <= 90]
    got = {}
    for r in nearest_join(p, s, ("lat", "lon"), ("la", "lo"), "sid", cell=cell).collect():
        got.setdefault(r.i, []).append(r)
    assert {i: len(r) for i, r in got.items()} == {i: 2 if i == 402 else 1 for i, *_ in points}
    for i, lat, lon in points:
        r = got[i][0]
        if i in (400, 401):
            assert r.nearest_id is None and r.nearest_km is None
            continue
        least = min(km((lat, lon), x[1:]) for x in real)
        near = [x[0] for x in real if km((lat, lon), x[1:]) <= least + 1e-9]
        assert abs(r.nearest_km - least) < 1e-6 and r.nearest_id in near
    assert got[403][0].nearest_id == 5


def test_nearest_of_nothing(spark):
    p = spark.createDataFrame([(1, 2.0, 3.0)], "i int, lat double, lon double")
    s = spark.createDataFrame([], "sid int, la double, lo double")
    assert rows_of(nearest_join(p, s, ("lat", "lon"), ("la", "lo"), "sid")) == [(1, 2.0, 3.0, None, None)]
    assert nearest_join(p.limit(0), s, ("lat", "lon"), ("la", "lo"), "sid").count() == 0
