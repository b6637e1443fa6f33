"""Registered queries: one per operator of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the driver's tables.
Trips are derived from the whole ``events`` table, so each query's work
grows with the data. Floating outputs are rounded to 6 places and every
computed column is aliased, so the result compares with its SQL twin in
``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import closed_form as CF
from meterline.operators.asof import asof_join
from meterline.operators.cross_validate import fold_of, ridge_cv
from meterline.operators.groupings import cube_sets, grouping_sets
from meterline.operators.interval import range_totals
from meterline.operators.nearest import nearest_join
from meterline.operators.quantile import exact_quantiles
from meterline.operators.sessions import sessions
from meterline.operators import clean as C
from meterline.operators import models as M
from meterline.operators.evaluate import best_model, leaderboard, regression_metrics
from meterline.operators.funnel import funnel_counts, funnel_labels
from meterline.operators.sample import ordered_sample
from meterline.operators.report import axis_bound, error_histogram, prediction_sample, with_absolute_error
from meterline.operators.split import hash_split, split_counts, with_split_flag
from meterline.operators.validate import MissingColumnsError, require_columns, select_required
from meterline.plans.common import rounded, ts_text
from meterline.plans.train import run_train
from meterline.schemas import CLEAN_COLUMNS, FEATURE_COLUMNS, FUNNEL_SCHEMA, IMPORTANCE_SCHEMA, RAW_COLUMNS, RAW_TRIP_SCHEMA, SAMPLE_COLUMNS
from meterline.session import scratch_path
from meterline.sources.fixtures import raw_trips_from_events, read_raw_trips
from meterline.sources.readers import read_clean_parquet, read_raw_csv, read_result_csv
from meterline.sources.sinks import load_pipeline_model, save_pipeline_model, write_parquet, write_single_csv

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_trips(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_trips(_raw(spark, sf_dir))


# ---------------------------------------------------------------- cleaning


def trips_clean(spark, sf_dir):
    return rounded(_clean(spark, sf_dir))


def raw_projection(spark, sf_dir):
    return rounded(select_required(_raw(spark, sf_dir), RAW_COLUMNS, "raw trip table"))


def parse_pickup_time(spark, sf_dir):
    parsed = C.parsed_raw(_raw(spark, sf_dir))
    return parsed.select("key", "pickup_datetime_clean", ts_text("pickup_timestamp"))


def time_features(spark, sf_dir):
    parsed = C.with_time_features(C.parsed_raw(_raw(spark, sf_dir)))
    return parsed.select("key", "pickup_hour", "pickup_dayofweek", "pickup_month", "pickup_year")


def haversine_distance(spark, sf_dir):
    return rounded(C.with_distance(_raw(spark, sf_dir)).select("key", "trip_distance_km"))


def dropna_subset(spark, sf_dir):
    complete = C.drop_incomplete(C.parsed_raw(_raw(spark, sf_dir)))
    return rounded(complete.select(*RAW_COLUMNS))


def dropna_all(spark, sf_dir):
    """The all-column drop on its own, over every parsed raw row."""
    full = C.with_time_features(C.with_distance(C.parsed_raw(_raw(spark, sf_dir))))
    kept = full.na.drop(subset=C.FINAL_COMPLETE_COLUMNS)
    return rounded(kept.select("key", "pickup_datetime_clean", "trip_distance_km", "pickup_hour", "pickup_year"))


def domain_filter(spark, sf_dir):
    complete = C.drop_incomplete(C.parsed_raw(_raw(spark, sf_dir)))
    return rounded(complete.filter(C.domain_predicate()).select(*RAW_COLUMNS))


def bbox_filter(spark, sf_dir):
    complete = C.drop_incomplete(C.parsed_raw(_raw(spark, sf_dir)))
    return rounded(
        complete.filter(C.bbox_predicate()).select(
            "key", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"
        )
    )


def distance_filter(spark, sf_dir):
    complete = C.drop_incomplete(C.parsed_raw(_raw(spark, sf_dir)))
    kept = C.with_distance(complete).filter(C.distance_predicate())
    return rounded(kept.select("key", "trip_distance_km"))


# ------------------------------------------------------- funnel and split


def funnel_counts_q(spark, sf_dir):
    return funnel_counts(_raw(spark, sf_dir))


def funnel_with_split(spark, sf_dir):
    return funnel_counts(_raw(spark, sf_dir), with_split=True)


def funnel_labels_q(spark, sf_dir):
    return funnel_labels(funnel_counts(_raw(spark, sf_dir), with_split=True))


def split_assignment(spark, sf_dir):
    return with_split_flag(_clean(spark, sf_dir)).select("key", "split_bucket", "is_train")


def split_counts_q(spark, sf_dir):
    return split_counts(_clean(spark, sf_dir))


def clean_sample(spark, sf_dir):
    return rounded(ordered_sample(_clean(spark, sf_dir), 1000))


def clean_sample_timestamp(spark, sf_dir):
    """The one-job profile's sample: 12 columns with the parsed pickup time."""
    clean = C.clean_trips(_raw(spark, sf_dir), ["key", *SAMPLE_COLUMNS])
    return rounded(ordered_sample(clean, 1000).withColumn("pickup_timestamp", ts_text("pickup_timestamp")))


def model_frame(spark, sf_dir):
    clean = _clean(spark, sf_dir).withColumnRenamed("fare_amount", "label")
    return rounded(clean.select("key", "label", *FEATURE_COLUMNS))


# ---------------------------------------------------------- sources/sinks


def csv_roundtrip(spark, sf_dir):
    """Raw trips -> header CSV -> read back with the explicit schema."""
    path = scratch_path(spark, "raw-csv")
    _raw(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return rounded(read_raw_csv(spark, path, RAW_TRIP_SCHEMA))


def csv_reordered(spark, sf_dir):
    """Columns in another order and one more among them -> read back by name."""
    path = scratch_path(spark, "raw-csv")
    mixed = [*RAW_COLUMNS[3:], "note", *RAW_COLUMNS[:3]]
    _raw(spark, sf_dir).withColumn("note", F.lit("not asked for")).select(*mixed).write.option("header", True).csv(path)
    return rounded(read_raw_csv(spark, path))


def csv_numeric_text(spark, sf_dir):
    """Passenger counts written as ``1.0`` -> read back as whole numbers."""
    path = scratch_path(spark, "raw-csv")
    _raw(spark, sf_dir).withColumn("passenger_count", F.col("passenger_count").cast("double")).write.option("header", True).csv(path)
    return rounded(read_raw_csv(spark, path))


def funnel_csv(spark, sf_dir):
    """The funnel through the one-file CSV sink and back."""
    path = scratch_path(spark, "funnel-csv")
    write_single_csv(funnel_counts(_raw(spark, sf_dir)), path)
    return read_result_csv(spark, path, FUNNEL_SCHEMA)


def parquet_roundtrip(spark, sf_dir):
    """Clean trips -> Parquet -> read back."""
    path = scratch_path(spark, "clean-parquet")
    write_parquet(_clean(spark, sf_dir), path)
    return rounded(read_clean_parquet(spark, path).select(*CLEAN_COLUMNS))


# ------------------------------------------------------ closed-form models

# Regularisation and the features of the small closed-form fits.
REG_PARAM = 0.1
ONE_FEATURE = "trip_distance_km"
TWO_FEATURES = ("trip_distance_km", "passenger_count")
STUMP_FEATURES = ["km_floor", "passenger_count", "pickup_hour"]


def _train_test(spark, sf_dir):
    frame = M.model_input(_clean(spark, sf_dir))
    return hash_split(frame)


def scaler_stats_q(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return rounded(CF.scaler_stats(train, FEATURE_COLUMNS))


def _scaled(spark, sf_dir, with_mean):
    train, _ = _train_test(spark, sf_dir)
    out = CF.standardize(train, FEATURE_COLUMNS, with_mean=with_mean)
    return rounded(out.select("key", *[f"{f}_scaled" for f in FEATURE_COLUMNS]))


def scaled_features(spark, sf_dir):
    return _scaled(spark, sf_dir, with_mean=False)


def scaled_centered_features(spark, sf_dir):
    return _scaled(spark, sf_dir, with_mean=True)


def ols_1f(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return rounded(CF.ols_1f(train, ONE_FEATURE))


def ridge_1f(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return rounded(CF.ridge_1f(train, ONE_FEATURE, reg=REG_PARAM))


def ridge_2f(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return rounded(CF.ridge_2f(train, *TWO_FEATURES, reg=REG_PARAM))


def tree_stump_q(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    train = train.withColumn("km_floor", F.floor("trip_distance_km").cast("int"))
    return rounded(CF.tree_stump(train, STUMP_FEATURES))


def ridge_1f_predictions(spark, sf_dir):
    """Test rows scored by the one-feature ridge fitted on the train rows."""
    train, test = _train_test(spark, sf_dir)
    coefs = CF.ridge_1f(train, ONE_FEATURE, reg=REG_PARAM).withColumnRenamed("slope", "w")
    return CF.linear_predictions(test, coefs, [ONE_FEATURE], ["w"])


def regression_metrics_q(spark, sf_dir):
    return rounded(regression_metrics(ridge_1f_predictions(spark, sf_dir)))


def absolute_error(spark, sf_dir):
    pred = with_absolute_error(ridge_1f_predictions(spark, sf_dir))
    return rounded(pred.select("key", "label", "prediction", "absolute_error"))


def _stored_predictions(spark, sf_dir) -> DataFrame:
    """The ridge predictions, scored once: the histogram and the sample read them twice."""
    path = scratch_path(spark, "ridge-predictions")
    write_parquet(ridge_1f_predictions(spark, sf_dir), path)
    return spark.read.parquet(path)


def error_histogram_q(spark, sf_dir):
    return rounded(error_histogram(_stored_predictions(spark, sf_dir)))


def axis_bound_q(spark, sf_dir):
    return rounded(axis_bound(ridge_1f_predictions(spark, sf_dir)))


def prediction_sample_q(spark, sf_dir):
    return rounded(prediction_sample(_stored_predictions(spark, sf_dir)))


# Names of the closed-form models in the leaderboard.
CLOSED_FORM_MODELS = ["OLS distance", "Ridge distance", "Ridge distance+passengers"]


def closed_form_evaluation(spark, sf_dir) -> DataFrame:
    """(model, rmse, mae, r2, position) for three closed-form fits, scored in one pass over the test rows."""
    train, test = _train_test(spark, sf_dir)
    # One aggregate pass over the train rows fits all three models.
    f = CF.linear_fits(train, *TWO_FEATURES, reg=REG_PARAM).select(F.struct("*").alias("s")).scalar()
    x, x2 = F.col(TWO_FEATURES[0]), F.col(TWO_FEATURES[1])
    preds = test.select(
        "label",
        (f["ols_intercept"] + f["ols_slope"] * x).alias("p0"),
        (f["ridge1_intercept"] + f["ridge1_slope"] * x).alias("p1"),
        (f["ridge2_intercept"] + f["ridge2_w1"] * x + f["ridge2_w2"] * x2).alias("p2"),
    )
    aggs = []
    for i in range(3):
        err = F.col("label") - F.col(f"p{i}")
        mse = F.avg(err * err)
        aggs += [F.sqrt(mse).alias(f"rmse{i}"), F.avg(F.abs(err)).alias(f"mae{i}"), (1 - F.try_divide(mse, F.var_pop("label"))).alias(f"r2{i}")]
    wide = preds.agg(*aggs)
    rows = [
        F.struct(F.lit(name).alias("model"), F.col(f"rmse{i}").alias("rmse"), F.col(f"mae{i}").alias("mae"), F.col(f"r2{i}").alias("r2"), F.lit(i).alias("position"))
        for i, name in enumerate(CLOSED_FORM_MODELS)
    ]
    return wide.select(F.inline(F.array(*rows)))


def leaderboard_q(spark, sf_dir):
    return rounded(leaderboard(closed_form_evaluation(spark, sf_dir)))


def best_model_q(spark, sf_dir):
    return rounded(best_model(closed_form_evaluation(spark, sf_dir)))


# ---------------------------------------------------- pyspark.ml models


# Events that are worth a task of their own in a fit's passes, and the most that one task takes.
MIN_TASK_EVENTS, MAX_TASK_EVENTS = 100_000, 2_000_000


def _spread_raw(spark, sf_dir) -> DataFrame:
    """Raw trips dealt evenly over the cluster's cores, by a hash of the whole row.

    A fit passes over its rows some 200 times in the tasks that they were
    written by. A Parquet row group is never divided, so without this the
    layout of ``events`` sets how many cores work, and how evenly.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "value")
    n = events.count()
    tasks = min(max(spark.sparkContext.defaultParallelism, n // MAX_TASK_EVENTS), n // MIN_TASK_EVENTS)
    return raw_trips_from_events(events.repartition(tasks, "event_id", "ts", "value") if tasks > 1 else events)


def _stored_split(spark, sf_dir, assembled: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the model frame, written once: every pass of a fit reads the narrow table, not ``events``.

    With ``assembled`` it is key, label and the feature vector, for fits that
    take the vector as it is instead of building it again in each pass.
    """
    path = scratch_path(spark, "model-frame")
    frame = M.model_input(C.clean_trips(_spread_raw(spark, sf_dir)))
    write_parquet(with_split_flag(M.assembled(frame, keep=["key", "label"]) if assembled else frame), path)
    frame = spark.read.parquet(path).drop("split_bucket")
    return frame.filter("is_train").drop("is_train"), frame.filter("NOT is_train").drop("is_train")


def _fit(train, test, profile, name):
    spec = next(s for s in M.model_specs(profile) if s.name == name)
    return M.train_one(spec, 0, train, test, isolate=False, pre_assembled="features" in train.columns)


def _predictions(spark, sf_dir, profile, name) -> DataFrame:
    result = _fit(*_stored_split(spark, sf_dir, assembled=True), profile, name)
    return rounded(result.predictions.select("key", "label", "prediction"))


def linear_full(spark, sf_dir):
    return _predictions(spark, sf_dir, "full", M.LINEAR)


def dt_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, "fast", M.TREE)


def rf_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, "fast", M.FOREST)


def gbt_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, "full", M.BOOSTED)


def dt_full_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, "full", M.TREE)


def rf_full_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir, "full", M.FOREST)


def _evaluation(spark, sf_dir, profile):
    train, test = _stored_split(spark, sf_dir, assembled=True)
    results = M.train_all(M.model_specs(profile), train, test, parallelism=2, pre_assembled=True)
    return M.results_table(spark, results).drop("position")


def evaluation_fast(spark, sf_dir):
    return rounded(_evaluation(spark, sf_dir, "fast"))


def evaluation_full(spark, sf_dir):
    return rounded(_evaluation(spark, sf_dir, "full"))


def feature_importance_dt(spark, sf_dir):
    result = _fit(*_stored_split(spark, sf_dir), "fast", M.TREE)
    return rounded(M.ranked_importances(M.feature_importances(spark, result)))


def model_reload_predictions(spark, sf_dir):
    """Fit, save the pipeline to the shared folder, load it back, score."""
    train, test = _stored_split(spark, sf_dir)
    path = save_pipeline_model(_fit(train, test, "fast", M.TREE).model, scratch_path(spark, "model"))
    return rounded(load_pipeline_model(path).transform(test).select("key", "label", "prediction"))


# Facts about the fitted models that SQL can state from the data alone. Each
# is necessary, not sufficient: tests compare the fits themselves.


def model_vector(spark, sf_dir):
    """The assembled feature vector, unpacked in its order."""
    vector = vector_to_array("features")
    cols = [F.get(vector, i).alias(f) for i, f in enumerate(FEATURE_COLUMNS)]
    return rounded(M.assembled(M.model_input(_clean(spark, sf_dir))).select("key", *cols))


def _ml_scaled(spark, sf_dir, profile):
    """The job's own scaler stage, fitted and applied to the training rows."""
    train, _ = _stored_split(spark, sf_dir)
    spec = M.model_specs(profile)[0]
    scaled = Pipeline(stages=[spec.assembler, spec.tail[0]]).fit(train).transform(train)
    vector = vector_to_array("scaled_features")
    return rounded(scaled.select("key", *[F.get(vector, i).alias(f"{f}_scaled") for i, f in enumerate(FEATURE_COLUMNS)]))


def ml_scaled_features(spark, sf_dir):
    return _ml_scaled(spark, sf_dir, "fast")


def ml_scaled_centered_features(spark, sf_dir):
    return _ml_scaled(spark, sf_dir, "full")


def mean_training_prediction(spark, sf_dir):
    """Full-profile linear, tree and boosted fits predict the mean training label on average."""
    train, _ = _stored_split(spark, sf_dir, assembled=True)
    out = None
    for name in (M.LINEAR, M.TREE, M.BOOSTED):
        scored = _fit(train, train, "full", name).predictions
        row = scored.agg(F.count("*").alias("rows"), F.avg("prediction").alias("mean_prediction")).select(F.lit(name).alias("model"), "rows", "mean_prediction")
        out = row if out is None else out.unionByName(row)
    return rounded(out)


def ridge_normal_equations(spark, sf_dir):
    """(feature, holds): the full-profile linear fit solves its penalised normal equations.

    In standardised space the residual's correlation with each feature equals
    the penalty times the coefficient, to 1e-6.
    """
    train, _ = _stored_split(spark, sf_dir)
    result = _fit(train, train, "full", M.LINEAR)
    weights = result.model.stages[-1].coefficients.toArray().tolist()
    x = vector_to_array("scaled_features")
    rows = result.predictions.select("label", (F.col("label") - F.col("prediction")).alias("residual"), *[F.get(x, i).alias(f) for i, f in enumerate(FEATURE_COLUMNS)])
    sd = F.stddev_pop("label")
    gaps = rows.agg(*[
        (F.covar_pop(f, "residual") / (F.stddev_pop(f) * sd) - F.lit(REG_PARAM * w) * F.stddev_pop(f) / (sd * sd)).alias(f) for f, w in zip(FEATURE_COLUMNS, weights)
    ])
    return gaps.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), (F.abs(f) < 1e-6).alias("holds")) for f in FEATURE_COLUMNS])))


def importance_facts(spark, sf_dir):
    """Importances of the fast and the full tree: how many, their sum, and whether they come largest first."""
    train, test = _stored_split(spark, sf_dir)
    out = None
    for profile in ("fast", "full"):
        table = M.ranked_importances(M.feature_importances(spark, _fit(train, test, profile, M.TREE)))
        row = _importance_row(table).select(F.lit(profile).alias("profile"), "features", "total", "sorted")
        out = row if out is None else out.unionByName(row)
    return rounded(out)


def _importance_row(table: DataFrame) -> DataFrame:
    """One row about an importance table (10 rows) in its given order."""
    listed = table.coalesce(1).agg(F.collect_list("importance").alias("v"), F.count("*").alias("features"), F.sum("importance").alias("total"))
    return listed.select("features", "total", (F.col("v") == F.reverse(F.array_sort("v"))).alias("sorted"))


def model_reload_differences(spark, sf_dir):
    """Rows that a saved and reloaded pipeline scores, and how many differ from the fitted one's."""
    train, test = _stored_split(spark, sf_dir)
    fitted = _fit(train, test, "fast", M.TREE)
    again = load_pipeline_model(save_pipeline_model(fitted.model, scratch_path(spark, "model")))
    both = again.transform(fitted.predictions.withColumnRenamed("prediction", "first").drop("features"))
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.col("prediction").eqNullSafe(F.col("first"))).alias("differing"))


def _label_variance(spark, sf_dir, profile):
    """RMSE and R² of the evaluation table give back the test label's variance for every model."""
    ev = _evaluation(spark, sf_dir, profile)
    return rounded(ev.select("model", F.round(F.col("rmse") * F.col("rmse") / (1 - F.col("r2")), 4).alias("label_variance"), (F.col("mae") <= F.col("rmse")).alias("mae_below_rmse")))


def evaluation_fast_facts(spark, sf_dir):
    return _label_variance(spark, sf_dir, "fast")


def evaluation_full_facts(spark, sf_dir):
    return _label_variance(spark, sf_dir, "full")


def stepped_fares(clean: DataFrame) -> DataFrame:
    """Clean trips whose fare goes up and down with whole kilometres, so that a tree model wins (see FIXTURES.md)."""
    steps = F.lit(20.0) * (F.floor("trip_distance_km") % 4).cast("double")
    return clean.withColumn("fare_amount", F.lit(5.0) + steps + F.lit(3.0) * F.col("passenger_count"))


def tree_wins(spark, sf_dir):
    """The training job on stepped fares: split, mean label, and the published importances of the winning tree model."""
    clean = stepped_fares(_clean(spark, sf_dir))
    base = scratch_path(spark, "tree-wins")
    summary, _ = run_train(spark, clean, base, profile="fast")
    table = read_result_csv(spark, summary.paths["feature_importance"], IMPORTANCE_SCHEMA)
    row = _importance_row(table)
    mean = clean.agg(F.avg("fare_amount").alias("mean_fare"))
    split = summary.split
    tree = F.lit(summary.best in M.TREE_MODELS).alias("tree_won")
    return rounded(row.select(tree, F.lit(split["train"]).cast("bigint").alias("train_rows"), F.lit(split["test"]).cast("bigint").alias("test_rows"), "features", "total", "sorted", mean.scalar().alias("mean_fare")))


# --------------------------------------------------------------- streaming


def stream_funnel(spark, sf_dir):
    """Raw trips land as CSV files; the streaming ingest cleans them four
    files per micro-batch; the running funnel must equal the batch funnel."""
    from meterline.streaming import funnel_totals, run_clean_stream

    base = scratch_path(spark, "stream")
    _raw(spark, sf_dir).write.option("header", True).csv(f"{base}/in")
    run_clean_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=4).awaitTermination()
    return funnel_totals(spark, f"{base}/out")


# ------------------------------------------------- joins on order and place


def asof_previous_event(spark, sf_dir):
    """Each purchase with its user's latest view at or before it; of views at one time the greatest id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    seen = events.filter("event_type = 'view'").select("user_id", "ts", "event_id", "value")
    found = asof_join(bought, seen, ["user_id"], "ts", "ts", prefix="view_")
    return rounded(found.withColumn("ts", ts_text("ts")).withColumn("view_ts", ts_text("view_ts")))


def orders_in_shipping_ranges(spark, sf_dir):
    """Orders placed while a supplier was shipping large lots, for each supplier and quarter."""
    lots = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_quantity >= 45")
    quarter = F.year("l_shipdate") * 4 + F.quarter("l_shipdate")
    ranges = lots.groupBy("l_suppkey", quarter.alias("quarter_no")).agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    found = range_totals(orders, ranges, "o_orderdate", "first_ship", "last_ship", ["cents"], closed=True, count_name="n_orders")
    return found.select("l_suppkey", "quarter_no", "n_orders", "cents")


def nearest_dropoff(spark, sf_dir):
    """How far each clean trip's start is from the nearest of the 500 busiest drop-off cells (a thousandth of a degree wide)."""
    trips = _clean(spark, sf_dir)
    row, col = F.floor(F.col("dropoff_latitude") * 1000).alias("row"), F.floor(F.col("dropoff_longitude") * 1000).alias("col")
    cells = trips.groupBy(row, col).agg(F.count("*").alias("n"), F.min("dropoff_latitude").alias("site_lat"), F.min("dropoff_longitude").alias("site_lon"))
    busiest = cells.orderBy(F.desc("n"), "row", "col").limit(500).withColumn("site", F.concat_ws(",", "row", "col"))
    starts = trips.select("key", "pickup_latitude", "pickup_longitude")
    found = nearest_join(starts, busiest, ("pickup_latitude", "pickup_longitude"), ("site_lat", "site_lon"), "site")
    return rounded(found.select("key", "nearest_km"))


# Facts that a wrong fit fails.


def tree_leaf_facts(spark, sf_dir):
    """Each tree's training predictions are the mean labels of the rows that get them, from several leaves and at most 2^depth."""
    train, _ = _stored_split(spark, sf_dir)
    total = train.agg(F.var_pop("label")).first()[0]
    out = None
    for profile in ("fast", "full"):
        scored = _fit(train, train, profile, M.TREE).predictions
        leaves = scored.groupBy("prediction").agg(F.count("*").alias("n"), F.avg("label").alias("mean"), F.var_pop("label").alias("spread"))
        off = F.count_if(F.abs(F.col("prediction") - F.col("mean")) > 1e-6)
        within = F.sum(F.col("n") * F.col("spread")) / F.sum("n")
        shape = F.count("*").between(2, 2 ** M.PROFILES[profile].tree_depth)
        row = leaves.agg(F.sum("n").alias("rows"), off.alias("leaves_off"), shape.alias("leaves_in_bounds"), (within < 0.5 * total).alias("halves_variance"))
        row = row.select(F.lit(profile).alias("profile"), "rows", "leaves_off", "leaves_in_bounds", "halves_variance")
        out = row if out is None else out.unionByName(row)
    return out


def forest_facts(spark, sf_dir):
    """The fast forest predicts the mean of its trees' predictions for every test row, and no tree equals another."""
    train, test = _stored_split(spark, sf_dir)
    result = _fit(train, test, "fast", M.FOREST)
    trees = result.model.stages[-1].trees
    scored = result.predictions.select("features", F.col("prediction").alias("whole"))
    for i, tree in enumerate(trees):
        scored = tree.setPredictionCol(f"tree_{i}").transform(scored)
    each = [F.col(f"tree_{i}") for i in range(len(trees))]
    mean = sum(each[1:], each[0]) / len(trees)
    alike = [F.count_if(a != b) == 0 for i, a in enumerate(each) for b in each[:i]]
    same = sum([a.cast("int") for a in alike[1:]], alike[0].cast("int"))
    return scored.agg(F.count("*").alias("rows"), F.lit(len(trees)).alias("trees"), F.count_if(F.abs(F.col("whole") - mean) > 1e-6).alias("differing"), same.alias("equal_pairs"))


def boosted_facts(spark, sf_dir):
    """The boosted fit is the weighted sum of its trees for every training row, and fits them better than its first tree."""
    train, _ = _stored_split(spark, sf_dir)
    result = _fit(train, train, "full", M.BOOSTED)
    fitted = result.model.stages[-1]
    scored = result.predictions.select("label", "features", F.col("prediction").alias("whole"))
    for i, tree in enumerate(fitted.trees):
        scored = tree.setPredictionCol(f"tree_{i}").transform(scored)
    total = sum(F.col(f"tree_{i}") * w for i, w in enumerate(fitted.treeWeights))
    mse = lambda c: F.avg((F.col("label") - F.col(c)) * (F.col("label") - F.col(c)))
    facts = scored.withColumn("summed", total)
    return facts.agg(F.count("*").alias("rows"), F.lit(len(fitted.trees)).alias("trees"), F.count_if(F.abs(F.col("whole") - F.col("summed")) > 1e-6).alias("differing"), (mse("whole") < 0.9 * mse("tree_0")).alias("beats_first_tree"))


def guard_messages(spark, sf_dir):
    """What the guards say: an input without three of its columns, and a training run in which every model fails."""
    trips = _raw(spark, sf_dir)
    said = []
    try:
        require_columns(trips.drop("key", "fare_amount", "dropoff_latitude"), RAW_COLUMNS, "raw trip table")
    except MissingColumnsError as error:
        said.append(("required_columns", ",".join(sorted(error.missing))))
    train, test = _stored_split(spark, sf_dir)
    # A feature is gone, so no model can be fitted.
    results = M.train_all(M.model_specs("fast"), train.drop("trip_distance_km"), test)
    try:
        M.successful(results)
    except RuntimeError as error:
        named = [r.name for r in results if r.name in str(error)]
        said.append(("every_model_failed", ",".join(sorted(named))))
    rows = trips.agg(F.count("*").alias("rows"))
    return spark.createDataFrame(said, "guard string, names string").select("guard", "names", rows.scalar().alias("rows"))


# ------------------------------------ cubes, quantiles, folds and sessions


def fare_cube(spark, sf_dir):
    """Trips, fares and distinct drop-off cells by hour, weekday and month, with every total."""
    dims = ["pickup_hour", "pickup_dayofweek", "pickup_month"]
    trips = _clean(spark, sf_dir).select(*dims, F.round(F.col("fare_amount") * 100).cast("long").alias("fare_cents"), F.floor(F.col("dropoff_longitude") * 100).alias("cell"))
    return grouping_sets(trips, dims, cube_sets(dims), count="trips", sums={"cents": "fare_cents"}, distinct={"cells": "cell"})


def error_quantiles(spark, sf_dir):
    """Exact quantiles of the absolute error over all test predictions."""
    errors = with_absolute_error(_stored_predictions(spark, sf_dir))
    return rounded(exact_quantiles(errors, "absolute_error", ["0.5", "0.9", "0.99"]))


# The penalties and folds of the cross-validated fit.
CV_PENALTIES = (0.01, 0.1, 1.0, 10.0)
CV_FOLDS = 5


def ridge_cv_q(spark, sf_dir):
    """Penalties of the two-feature ridge over five folds of all clean trips."""
    frame = M.model_input(_clean(spark, sf_dir)).withColumn("fold", fold_of("key", CV_FOLDS))
    return rounded(ridge_cv(frame, list(TWO_FEATURES), list(CV_PENALTIES)))


SESSION_GAP_MICROS = 6 * 3_600_000_000


def user_sessions(spark, sf_dir):
    """Each user's events as sessions: no six hours without an event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("value_cents", F.round(F.col("value") * 100).cast("long"))
    found = sessions(events, ["user_id"], "ts", SESSION_GAP_MICROS, sums={"cents": "value_cents"})
    return found.withColumn("session_start", ts_text("session_start")).withColumn("session_end", ts_text("session_end"))


QUERIES: dict[str, Query] = {
    "trips_clean": trips_clean,
    "raw_projection": raw_projection,
    "parse_pickup_time": parse_pickup_time,
    "time_features": time_features,
    "haversine_distance": haversine_distance,
    "dropna_subset": dropna_subset,
    "dropna_all": dropna_all,
    "domain_filter": domain_filter,
    "bbox_filter": bbox_filter,
    "distance_filter": distance_filter,
    "funnel_counts": funnel_counts_q,
    "funnel_with_split": funnel_with_split,
    "funnel_labels": funnel_labels_q,
    "split_assignment": split_assignment,
    "split_counts": split_counts_q,
    "clean_sample": clean_sample,
    "clean_sample_timestamp": clean_sample_timestamp,
    "model_frame": model_frame,
    "csv_roundtrip": csv_roundtrip,
    "csv_reordered": csv_reordered,
    "csv_numeric_text": csv_numeric_text,
    "funnel_csv": funnel_csv,
    "parquet_roundtrip": parquet_roundtrip,
    "scaler_stats": scaler_stats_q,
    "scaled_features": scaled_features,
    "scaled_centered_features": scaled_centered_features,
    "ols_1f": ols_1f,
    "ridge_1f": ridge_1f,
    "ridge_2f": ridge_2f,
    "tree_stump": tree_stump_q,
    "regression_metrics": regression_metrics_q,
    "absolute_error": absolute_error,
    "error_histogram": error_histogram_q,
    "axis_bound": axis_bound_q,
    "prediction_sample": prediction_sample_q,
    "leaderboard": leaderboard_q,
    "best_model": best_model_q,
    "linear_full": linear_full,
    "dt_predictions": dt_predictions,
    "rf_predictions": rf_predictions,
    "gbt_predictions": gbt_predictions,
    "evaluation_fast": evaluation_fast,
    "evaluation_full": evaluation_full,
    "feature_importance_dt": feature_importance_dt,
    "model_reload_predictions": model_reload_predictions,
    "dt_full_predictions": dt_full_predictions,
    "rf_full_predictions": rf_full_predictions,
    "model_vector": model_vector,
    "ml_scaled_features": ml_scaled_features,
    "ml_scaled_centered_features": ml_scaled_centered_features,
    "mean_training_prediction": mean_training_prediction,
    "ridge_normal_equations": ridge_normal_equations,
    "importance_facts": importance_facts,
    "model_reload_differences": model_reload_differences,
    "evaluation_fast_facts": evaluation_fast_facts,
    "evaluation_full_facts": evaluation_full_facts,
    "tree_wins": tree_wins,
    "stream_funnel": stream_funnel,
    "asof_previous_event": asof_previous_event,
    "orders_in_shipping_ranges": orders_in_shipping_ranges,
    "nearest_dropoff": nearest_dropoff,
    "tree_leaf_facts": tree_leaf_facts,
    "forest_facts": forest_facts,
    "boosted_facts": boosted_facts,
    "guard_messages": guard_messages,
    "fare_cube": fare_cube,
    "error_quantiles": error_quantiles,
    "ridge_cv": ridge_cv_q,
    "user_sessions": user_sessions,
}
