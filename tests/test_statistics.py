"""Grouping sets, exact quantiles, cross-validated ridge and sessions against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from meterline.operators.cross_validate import fold_moments, fold_of, ridge_cv, solve_ridge
from meterline.operators.groupings import cube_sets, grouping_sets, rollup_sets
from meterline.operators.quantile import exact_quantiles, quantile_rank
from meterline.operators.sessions import sessions

# ---------------------------------------------------------- grouping sets


def brute_sets(rows, dims, sets):
    out = set()
    for s in sets:
        groups = defaultdict(list)
        for r in rows:
            groups[tuple(r[i] if i in s else None for i in range(dims))].append(r)
        gid = sum(1 << (dims - 1 - i) for i in range(dims) if i not in s)
        for key, members in groups.items():
            told = [r[dims] for r in members if r[dims] is not None]
            kinds = {r[dims + 1] for r in members} - {None}
            out.add((*key, gid, len(members), sum(told) if told else None, len(kinds)))
    return out


@pytest.mark.parametrize("kind", ["cube", "rollup", "some"])
def test_grouping_sets_against_brute_force(spark, kind):
    rng = random.Random(1)
    # One group holds a third of all rows; dimensions and values hold nulls, rows repeat.
    rows = [(rng.choice([1, 1, 2, 3, None]), rng.choice("aab") if rng.random() < 0.9 else None, rng.choice([None, *range(9)]), rng.choice(["x", "y", "z", None])) for _ in range(400)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "`a.b` int, b string, v bigint, u string")
    dims = ["a.b", "b"]
    sets = {"cube": cube_sets(dims), "rollup": rollup_sets(dims), "some": [["b"], []]}[kind]
    got = grouping_sets(df, dims, sets, sums={"total": "v"}, distinct={"kinds": "u"})
    assert got.columns == ["a.b", "b", "grouping_id", "rows", "total", "kinds"]
    listed = [tuple(r) for r in got.collect()]
    assert len(listed) == len(set(listed))
    assert set(listed) == brute_sets(rows, 2, [[dims.index(d) for d in s] for s in sets])


def test_grouping_sets_combine_rows_before_they_are_copied(spark):
    df = spark.range(1000).selectExpr("id % 3 AS d", "id AS v")
    plan = grouping_sets(df, ["d"], cube_sets(["d"]), sums={"v_sum": "v"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # plans print from the top down


def test_grouping_sets_edges(spark):
    df = spark.createDataFrame([], "d int, v bigint")
    assert grouping_sets(df, ["d"], cube_sets(["d"])).count() == 0
    for bad in (dict(sets=[["d"], ["d"]]), dict(sets=[["x"]]), dict(sets=[["d"]], count="d"), dict(sets=[["d"]], sums={"grouping_id": "v"})):
        with pytest.raises(ValueError):
            grouping_sets(df, ["d"], **bad)


# ---------------------------------------------------------------- quantiles


def brute_quantile(values, q):
    ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return ordered[quantile_rank(q, len(ordered)) - 1]


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


SHAPES = {
    "uniform": lambda rng: [rng.uniform(-5, 5) for _ in range(700)],
    "ties": lambda rng: [rng.choice([0.0, -0.0, 1.0, 1.0, 1.0, 2.5]) for _ in range(500)],
    "exponents": lambda rng: [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300) for _ in range(400)],
    "neighbours": lambda rng: [math.nextafter(1.0, 2.0) if rng.random() < 0.5 else 1.0 for _ in range(100)] + [1e300, 5e-324, 0.0],
    "not finite": lambda rng: [math.nan, math.inf, -math.inf, 1e308, -1e308] * 20 + [rng.random() for _ in range(40)],
    "hot": lambda rng: [7.25] * 400 + [rng.expovariate(1) for _ in range(800)],
    "one": lambda rng: [3.5],
    "nan": lambda rng: [math.nan] * 5,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_against_sorting(spark, shape):
    values = SHAPES[shape](random.Random(2)) + [None] * 7
    df = spark.createDataFrame([(v,) for v in values], "`v.w` double")
    quantiles = ["0", "0.5", "0.9", "1", "0.5"]
    got = exact_quantiles(df, "v.w", quantiles, bins=128).collect()
    assert [r.quantile for r in got] == [float(q) for q in quantiles]
    for r, q in zip(got, quantiles):
        assert same(r.value, brute_quantile(values, q)), (shape, q)


@pytest.mark.parametrize("shape", ["exponents", "lognormal", "negative"])
def test_quantile_rounds_stay_few(spark, monkeypatch, shape):
    rng = random.Random(3)
    values = SHAPES[shape](rng) if shape in SHAPES else [rng.lognormvariate(0, 20) * (-1 if shape == "negative" else 1) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    from meterline.operators import quantile as Q

    calls = []
    plain = Q._bin
    monkeypatch.setattr(Q, "_bin", lambda *a: calls.append(a) or plain(*a))
    assert exact_quantiles(df, "v", ["0.5"]).first().value == brute_quantile(values, "0.5")
    assert len(calls) <= 5


def test_quantile_edges(spark):
    none = spark.createDataFrame([(None,)], "v double")
    assert [tuple(r) for r in exact_quantiles(none, "v", ["0.5"]).collect()] == [(0.5, None, None)]
    assert exact_quantiles(spark.createDataFrame([(3,), (1,)], "v int"), "v", ["0.5"]).first().value == 1.0
    with pytest.raises(TypeError):
        exact_quantiles(spark.range(3), "id", ["0.5"])
    with pytest.raises(ValueError):
        exact_quantiles(none, "v", ["1.5"])


def test_quantile_rank_is_exact():
    assert quantile_rank("0.9", 10) == 9 and quantile_rank(0.7, 10) == 7 and quantile_rank("0.1", 3) == 1 and quantile_rank("0", 5) == 1


# ----------------------------------------------------------- cross-validation


@pytest.fixture(scope="module")
def sheet(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        a, b, c = rng.gauss(1e4, 2), rng.gauss(0, 1), rng.random()
        rows.append((str(i), a, b, c, 2.0, 0.5 * a - 3 * b + 7 * c + rng.gauss(0, 1)))
    return spark.createDataFrame(rows, "key string, a double, b double, c double, still double, label double").withColumn("fold", fold_of("key", 4)).cache()


def test_ridge_cv_against_ml(sheet):
    features, penalties = ["a", "b", "c"], [0.0, 0.1, 3.0]
    got = {(r.penalty, r.fold): r for r in ridge_cv(sheet, features, penalties).collect()}
    assert len(got) == 12
    for penalty in penalties:
        for k in range(4):
            train, test = sheet.filter(F.col("fold") != k), sheet.filter(F.col("fold") == k)
            pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="f"), LinearRegression(featuresCol="f", labelCol="label", regParam=penalty, elasticNetParam=0.0, solver="normal")])
            want = RegressionEvaluator(metricName="rmse").evaluate(pipe.fit(train).transform(test))
            row = got[penalty, k]
            assert row.rmse == pytest.approx(want, rel=1e-6)
            assert (row.train_rows, row.test_rows) == (train.count(), test.count())
    means = {p: np.mean([got[p, k].rmse ** 2 for k in range(4)]) for p in penalties}
    assert {p for p in penalties if got[p, 0].chosen} == {min(means, key=means.get)}
    assert all(got[p, k].mean_mse == pytest.approx(means[p]) for p, k in got)


def test_ridge_cv_reads_its_input_once(spark, sheet, monkeypatch):
    from meterline.operators import cross_validate as V

    calls = []
    plain = V.fold_moments
    monkeypatch.setattr(V, "fold_moments", lambda *a: calls.append(a) or plain(*a))
    V.ridge_cv(sheet, ["a", "b"], [0.1, 1.0, 10.0])
    assert len(calls) == 1


def test_ridge_cv_edges(spark, sheet):
    # A feature that stays the same weighs nothing; incomplete rows are left out.
    with_still = ridge_cv(sheet, ["b", "still"], [0.1]).select("fold", "rmse").collect()
    without = ridge_cv(sheet, ["b"], [0.1]).select("fold", "rmse").collect()
    assert {r.fold: round(r.rmse, 9) for r in with_still} == {r.fold: round(r.rmse, 9) for r in without}
    bad = spark.createDataFrame([("x", None, 1.0, 0), ("y", math.nan, 1.0, 1), ("z", 1.0, None, 0), ("w", 1.0, 2.0, None)], "key string, b double, label double, fold int")
    more = sheet.select("key", "b", "label", "fold").unionByName(bad)
    assert {k: m.rows for k, m in fold_moments(more, ["b"], "label", "fold").items()} == {k: m.rows for k, m in fold_moments(sheet, ["b"], "label", "fold").items()}
    assert ridge_cv(sheet.limit(0), ["b"], [0.1]).count() == 0
    assert ridge_cv(sheet.withColumn("fold", F.lit(0)), ["b"], [0.1]).count() == 0
    constant = fold_moments(sheet.withColumn("label", F.lit(5.0)), ["b"], "label", "fold")[0]
    weights, intercept = solve_ridge(constant, 0.1)
    assert weights.tolist() == [0.0] and intercept == pytest.approx(5.0)


def test_merged_moments_are_the_whole_table(sheet):
    parts = fold_moments(sheet, ["a", "b"], "label", "fold")
    whole = fold_moments(sheet.withColumn("fold", F.lit(0)), ["a", "b"], "label", "fold")[0]
    merged = parts[0].merged(parts[1]).merged(parts[2]).merged(parts[3])
    assert merged.rows == whole.rows
    np.testing.assert_allclose(merged.mean, whole.mean, rtol=1e-12)
    np.testing.assert_allclose(merged.cov, whole.cov, rtol=1e-9, atol=1e-9)


# ------------------------------------------------------------------ sessions


def brute_sessions(rows, gap):
    by_user = defaultdict(list)
    for u, t, v in rows:
        if u is not None and t is not None:
            by_user[u].append((t, v))
    out = []
    for u, line in by_user.items():
        line.sort(key=lambda r: r[0])
        group = [line[0]]
        for r in [*line[1:], (math.inf, None)]:
            if r[0] - group[-1][0] > gap:
                told = [v for _, v in group if v is not None]
                out.append((u, group[0][0], group[-1][0], len(group), sum(told) if told else None))
                group = []
            group.append(r)
    return sorted(out, key=str)


@pytest.mark.parametrize("gap, width", [(0, None), (5, None), (0, 1), (5, 7), (1000, 50)])
def test_sessions_against_brute_force(spark, gap, width):
    rng = random.Random(5)
    # User 0 holds a third of all rows; times tie, some are below zero, rows repeat.
    rows = [(rng.choice([0, 0, 0, 1, 2, 3, 4, 5, None]), rng.choice([None, *(rng.randrange(-200, 200) for _ in range(12))]), rng.choice([None, 1, 2])) for _ in range(300)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "`u.v` int, t bigint, n bigint")
    got = sessions(df, ["u.v"], "t", gap, sums={"total": "n"}, width=width)
    assert got.columns == ["u.v", "session_start", "session_end", "rows", "total"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_sessions(rows, gap)


def test_sessions_spread_a_hot_user(spark):
    line = spark.range(20_000).selectExpr("'u' AS u", "id * 10 + IF(id % 100 = 0, 5, 0) AS t")
    one = sorted(map(tuple, sessions(line, ["u"], "t", 9).collect()))
    many = sorted(map(tuple, sessions(line, ["u"], "t", 9, rows_per_bucket=500).collect()))
    assert one == many and len(one) == 200 * 99
    whole = sessions(line, ["u"], "t", 15, rows_per_bucket=500).collect()
    assert [(r.session_start, r.rows) for r in whole] == [(5, 20_000)]


def test_sessions_of_times_and_edges(spark):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2024-03-10 01:59:59'), (1, timestamp_ntz'2024-03-10 02:30:00'), (1, timestamp_ntz'2024-03-10 04:00:00') AS x(u, t)")
    assert sorted(r.rows for r in sessions(df, ["u"], "t", 3_600_000_000).collect()) == [1, 2]
    assert sessions(df.limit(0), ["u"], "t", 5).count() == 0
    with pytest.raises(ValueError):
        sessions(df, ["u"], "t", 5, sums={"rows": "u"})
    with pytest.raises(ValueError):
        sessions(df, ["u"], "t", -1)
