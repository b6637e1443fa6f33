"""Closed forms against pyspark.ml, and the training wrapper's contracts."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from meterline.operators import closed_form as CF
from meterline.operators import models as M
from meterline.operators.clean import clean_trips
from meterline.operators.evaluate import best_model, evaluation_table, leaderboard, metrics_dict
from meterline.operators.split import hash_split
from meterline.sources.fixtures import read_raw_trips
from meterline.sources.sinks import load_pipeline_model, save_pipeline_model

from .conftest import SF01


def stable_layout(df, partitions, key="key"):
    """Fixed partitioning and order, so forests (which sample per partition) repeat exactly."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


@pytest.fixture(scope="module")
def frames(spark):
    frame = M.model_input(clean_trips(read_raw_trips(spark, SF01)))
    train, test = hash_split(frame)
    # Fixed layout so forest sampling repeats exactly.
    train = stable_layout(train, 4).cache()
    test = stable_layout(test, 4).cache()
    yield train, test
    train.unpersist()
    test.unpersist()


def _lr(train, cols, reg):
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=cols, outputCol="f"),
            LinearRegression(featuresCol="f", labelCol="label", regParam=reg, elasticNetParam=0.0, solver="normal"),
        ]
    )
    return pipe.fit(train).stages[-1]


def test_ols_and_ridge_1f_match_ml(frames):
    train, _ = frames
    ols = CF.ols_1f(train, "trip_distance_km").first()
    m = _lr(train, ["trip_distance_km"], 0.0)
    assert ols.slope == pytest.approx(m.coefficients[0], rel=1e-9)
    assert ols.intercept == pytest.approx(m.intercept, rel=1e-9)
    r = CF.ridge_1f(train, "trip_distance_km", reg=0.1).first()
    m = _lr(train, ["trip_distance_km"], 0.1)
    assert r.slope == pytest.approx(m.coefficients[0], rel=1e-7)
    assert r.intercept == pytest.approx(m.intercept, rel=1e-7)


def test_ridge_2f_matches_ml(frames):
    train, _ = frames
    r = CF.ridge_2f(train, "trip_distance_km", "passenger_count", reg=0.1).first()
    m = _lr(train, ["trip_distance_km", "passenger_count"], 0.1)
    assert r.w1 == pytest.approx(m.coefficients[0], rel=1e-6)
    assert r.w2 == pytest.approx(m.coefficients[1], rel=1e-4, abs=1e-6)
    assert r.intercept == pytest.approx(m.intercept, rel=1e-6)


def test_scaler_matches_ml(frames):
    train, _ = frames
    feats = ["trip_distance_km", "pickup_hour", "passenger_count"]
    ml = Pipeline(
        stages=[VectorAssembler(inputCols=feats, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="s", withMean=True, withStd=True)]
    ).fit(train)
    stats = {r.feature: r for r in CF.scaler_stats(train, feats).collect()}
    sm = ml.stages[-1]
    for i, f in enumerate(feats):
        assert stats[f].mean == pytest.approx(sm.mean[i], rel=1e-12)
        assert stats[f].std == pytest.approx(sm.std[i], rel=1e-12)
    ours = CF.standardize(train, feats, with_mean=True).orderBy("key").collect()
    theirs = ml.transform(train).orderBy("key").select("s").collect()
    for a, b in zip(ours[:200], theirs[:200]):
        for i, f in enumerate(feats):
            assert a[f"{f}_scaled"] == pytest.approx(b.s[i], abs=1e-9)


def test_stump_matches_ml(frames):
    train, _ = frames
    t = train.withColumn("km_floor", F.floor("trip_distance_km").cast("int"))
    feats = ["km_floor", "passenger_count", "pickup_hour"]
    ours = CF.tree_stump(t, feats).first()
    model = Pipeline(
        stages=[VectorAssembler(inputCols=feats, outputCol="f"), DecisionTreeRegressor(featuresCol="f", labelCol="label", maxDepth=1)]
    ).fit(t).stages[-1]
    root = model._call_java("rootNode")
    split = root.split()
    assert feats[split.featureIndex()] == ours.feature
    assert split.threshold() == pytest.approx(ours.threshold)
    assert root.leftChild().prediction() == pytest.approx(ours.left_mean)
    assert root.rightChild().prediction() == pytest.approx(ours.right_mean)


def test_one_pass_metrics_match_evaluator(frames):
    train, test = frames
    spec = M.model_specs("fast")[0]
    res = M.train_one(spec, 0, train, test, isolate=False)
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=name).evaluate(res.predictions)
        assert getattr(res, name) == pytest.approx(ev, rel=1e-9, abs=1e-12)
    assert res.rmse == pytest.approx(1.482754, abs=5e-6)


def test_failure_isolation_and_all_failed(spark, frames):
    train, test = frames
    bad = M.ModelSpec("Broken", VectorAssembler(inputCols=["no_such_column"], outputCol="features"), [DecisionTreeRegressor()])
    good = M.model_specs("fast")[1]
    results = M.train_all([bad, good], train, test)
    assert [r.success for r in results] == [False, True]
    assert M.best_result(results).name == M.TREE
    assert M.results_table(spark, results).count() == 1
    with pytest.raises(RuntimeError):
        M.successful([results[0]])
    with pytest.raises(Exception):
        M.train_one(bad, 0, train, test, isolate=False)


def test_ties_go_to_earlier_model(spark):
    ev = evaluation_table(spark, [("A", 2.0, 1.0, 0.5), ("B", 1.0, 1.0, 0.6), ("C", 1.0, 0.9, 0.7)])
    assert best_model(ev).first().model == "B"
    ranks = {r.model: (r.rank_rmse, r.rank_mae, r.rank_r2) for r in leaderboard(ev).collect()}
    assert ranks == {"A": (3, 2, 3), "B": (1, 3, 2), "C": (2, 1, 1)}
    tied = [M.ModelResult("X", 0, True, rmse=1.0), M.ModelResult("Y", 1, True, rmse=1.0)]
    assert M.best_result(tied).name == "X"


def test_tree_importances_and_reload(spark, frames, tmp_out):
    train, test = frames
    spec = M.model_specs("fast")[2]
    res = M.train_one(spec, 0, train, test, isolate=False)
    imp = M.feature_importances(spark, res)
    assert imp.count() == 10
    assert sum(r.importance for r in imp.collect()) == pytest.approx(1.0, abs=1e-12)
    assert res.r2 > 0.9
    path = save_pipeline_model(res.model, f"{tmp_out}/model")
    again = load_pipeline_model(path).transform(test).select("key", "prediction")
    a = {r.key: r.prediction for r in again.collect()}
    b = {r.key: r.prediction for r in res.predictions.select("key", "prediction").collect()}
    assert a == b
    assert M.feature_importances(spark, M.ModelResult(M.LINEAR, 0, True)) is None


def test_metrics_dict_on_constant_prediction(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    m = metrics_dict(df)
    assert {k: m[k] for k in ("rmse", "mae", "r2")} == {"rmse": 1.0, "mae": 1.0, "r2": 0.0}
    assert (m["min_abs_error"], m["max_abs_error"], m["max_label"], m["max_prediction"]) == (1.0, 1.0, 3.0, 2.0)


def test_parallel_training_equals_sequential(frames):
    train, test = frames
    specs = M.model_specs("fast")
    seq = M.train_all(specs, train, test)
    par = M.train_all(M.model_specs("fast"), train, test, parallelism=3)
    assert [(r.name, r.rmse, r.mae, r.r2) for r in seq] == [(r.name, r.rmse, r.mae, r.r2) for r in par]


def test_metrics_pass_extras_match_report_tables(frames):
    from meterline.operators.report import axis_bound, error_histogram

    train, test = frames
    res = M.train_one(M.model_specs("fast")[1], 0, train, test, isolate=False)
    x = res.extras
    assert max(x["max_label"], x["max_prediction"]) == axis_bound(res.predictions).first().axis_max
    a = sorted(map(tuple, error_histogram(res.predictions).collect()))
    b = sorted(map(tuple, error_histogram(res.predictions, bounds=(x["min_abs_error"], x["max_abs_error"])).collect()))
    assert a == b


def test_constant_label_gives_no_r2(spark):
    df = spark.createDataFrame([(4.0, 3.0, 1.0, 0.0), (4.0, 5.0, 2.0, 1.0)], "label double, prediction double, x double, z double")
    m = metrics_dict(df)
    assert (m["rmse"], m["mae"], m["r2"]) == (1.0, 1.0, None)
    assert CF.ridge_1f(df, "x").first().slope is None
    assert CF.ridge_2f(df, "x", "z").first().w1 is None
    best = M.best_result([M.ModelResult("X", 0, True), M.ModelResult("Y", 1, True, rmse=2.0)])
    assert best.name == "Y"


def test_histogram_has_every_bin(spark):
    from meterline.operators.report import error_histogram

    df = spark.createDataFrame([(0.0, 0.0), (0.0, 10.0), (0.0, 9.9)], "label double, prediction double")
    got = [(r.bin, round(r.bin_lo, 6), r.n) for r in error_histogram(df, bins=10).orderBy("bin").collect()]
    assert got == [(i, float(i), {0: 1, 9: 2}.get(i, 0)) for i in range(10)]
    assert [r.n for r in error_histogram(df.limit(0), bins=3).collect()] == [0, 0, 0]


def test_failure_text_carries_the_message(frames):
    train, test = frames
    bad = M.ModelSpec("Broken", VectorAssembler(inputCols=["no_such_column"], outputCol="features"), [DecisionTreeRegressor()])
    with pytest.raises(RuntimeError, match="no_such_column"):
        M.successful(M.train_all([bad], train, test))


def test_pre_assembled_training_equals_pipeline_training(frames, tmp_out):
    train, test = frames
    specs = M.model_specs("fast")
    plain = M.train_all(specs, train, test)
    tr_a = M.assembled(train, keep=["label"])
    te_a = M.assembled(test)
    fast = M.train_all(M.model_specs("fast"), tr_a, te_a, pre_assembled=True, parallelism=3)
    assert [(r.rmse, r.mae, r.r2) for r in plain] == [(r.rmse, r.mae, r.r2) for r in fast]
    # The returned model still starts from raw columns.
    again = fast[0].model.transform(test).select("key", "prediction").orderBy("key").collect()
    first = fast[0].predictions.select("key", "prediction").orderBy("key").collect()
    assert again == first


def test_fits_share_out_one_row_group(spark, tmp_path):
    """Events in one file of one row group: training rows lie evenly in several tasks, with the vector the assembler builds, none lost."""
    from meterline.plans import catalog

    n = 2 * catalog.MIN_TASK_EVENTS
    events = spark.range(n).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "1 + id % 40 / 10D AS value")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert spark.sparkContext.defaultParallelism > 1
    train, test = catalog._stored_split(spark, str(tmp_path), assembled=True)
    sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 2 and max(sizes) < 1.1 * min(sizes)
    whole = M.assembled(M.model_input(clean_trips(read_raw_trips(spark, str(tmp_path)))), keep=["key", "label"])
    want_train, want_test = hash_split(whole)
    for got, want in ((train, want_train), (test, want_test)):
        assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).isEmpty()
