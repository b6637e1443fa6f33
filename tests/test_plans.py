"""Physical-plan checks: the scale properties the README claims."""

import re

import pytest

import __spark_entry__ as E
from meterline.operators.clean import clean_from_flags, clean_trips, with_stage_flags
from meterline.operators.funnel import funnel_counts
from meterline.operators.sample import hash_bound_frame, ordered_sample
from meterline.sources.fixtures import read_raw_trips
from meterline.sources.readers import read_raw_csv

from .conftest import SF001

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def raw_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "csv")
    read_raw_trips(spark, SF001).write.option("header", True).csv(path)
    return path


def test_range_filters_reach_the_csv_scan(spark, raw_csv):
    p = plan(clean_trips(read_raw_csv(spark, raw_csv)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", p).group(1)
    for f in ("GreaterThan(fare_amount,0.0)", "LessThanOrEqual(fare_amount,300.0)",
              "GreaterThanOrEqual(pickup_longitude,-75.0)", "LessThanOrEqual(dropoff_latitude,42.0)"):
        assert f in pushed
    assert "Exchange" not in p
    # The timestamp parse appears once (one generator), not once per check.
    assert len(re.findall(r"^\(\d+\) Scan csv", p, re.M)) == 1


def test_one_scan_write_plan_has_no_exchange(spark, raw_csv):
    p = plan(clean_from_flags(with_stage_flags(read_raw_csv(spark, raw_csv))))
    assert "Exchange" not in p and "Scan csv" in p


def test_funnel_is_one_aggregate_with_a_single_row_exchange(spark, raw_csv):
    p = plan(funnel_counts(read_raw_csv(spark, raw_csv)))
    assert len(re.findall(r"^\(\d+\) Scan csv", p, re.M)) == 1
    exchanges = re.findall(r"^\(\d+\) Exchange.*?\nArguments: ([^\n]*)", p, re.M | re.S)
    assert len(exchanges) == 1 and exchanges[0].startswith("SinglePartition")


def test_sample_bound_reads_only_key(spark, tmp_path):
    path = str(tmp_path / "clean")
    clean_trips(read_raw_trips(spark, SF001)).write.parquet(path)
    clean = spark.read.parquet(path)
    bound = plan(hash_bound_frame(clean, 1000))
    assert "ReadSchema: struct<key:string>" in bound
    p = plan(ordered_sample(clean, 1000))
    assert "TakeOrderedAndProject" in p and "Subquery" not in p


# These write or fit before they return; the others are one lazy plan.
EAGER = {
    "csv_roundtrip", "csv_reordered", "csv_numeric_text", "funnel_csv", "parquet_roundtrip", "stream_funnel", "error_histogram", "prediction_sample",
    "ml_scaled_features", "ml_scaled_centered_features", "mean_training_prediction", "ridge_normal_equations", "importance_facts",
    "model_reload_differences", "evaluation_fast_facts", "evaluation_full_facts", "tree_wins",
}
LAZY = sorted(n for n in E.oracle_sql() if n not in EAGER and not re.match(r"op\d+_|pipeline$", n))


@pytest.fixture(scope="module")
def many_splits(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("many"))
    spark.read.parquet(f"{SF001}/events.parquet").repartition(11).write.parquet(f"{base}/events.parquet")
    return base


def parquet_scans(node):
    """Parquet scans of an executed plan, subqueries included, reused parts once."""
    name = node.nodeName()
    if name.startswith("Reused"):
        return 0
    if name == "AdaptiveSparkPlan":
        return parquet_scans(node.executedPlan())
    if name.endswith("QueryStage"):
        return parquet_scans(node.plan())
    below = [s.apply(i) for s in (node.children(), node.subqueries()) for i in range(s.size())]
    return int(name.startswith("Scan parquet")) + sum(map(parquet_scans, below))


@pytest.mark.parametrize("name", LAZY)
def test_scans_of_events_on_many_splits(spark, many_splits, name):
    """Fits read the table once and scoring once more; everything else is one scan. No plan deals rows out anew."""
    df = E.queries()[name](spark, many_splits)
    df.collect()
    scored = {"regression_metrics", "absolute_error", "leaderboard", "best_model", "axis_bound", "scaled_features", "scaled_centered_features"}
    scans = parquet_scans(df._jdf.queryExecution().executedPlan())
    assert 1 <= scans <= (2 if name in scored else 1), (name, scans)
    assert "RoundRobinPartitioning" not in plan(df)


@pytest.mark.parametrize("name", ["scaled_features", "scaled_centered_features"])
def test_scaler_statistics_are_one_subquery(spark, name):
    assert len(re.findall(r"^Subquery:", plan(E.queries()[name](spark, SF001)), re.M)) == 1


@pytest.mark.parametrize("name", LAZY)
def test_no_joins_or_python_in_registered_queries(spark, name):
    p = plan(E.queries()[name](spark, SF001), "extended")
    for j in JOINS:
        assert j not in p, (name, j)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
