"""Jobs end to end: files, tables, CLI entry points."""

import json

import pytest
from pyspark.sql import functions as F

from meterline.operators import models as M
from meterline.operators.sample import bound_bits_for_total, ordered_sample, write_ordered_sample
from meterline.plans import combined, preprocess, train
from meterline.schemas import EVALUATION_SCHEMA, FUNNEL_SCHEMA, IMPORTANCE_SCHEMA
from meterline.sources.fixtures import read_raw_trips
from meterline.sources.readers import read_result_csv
from meterline.sources.sinks import publish_tables

from .conftest import SF001


def test_preprocess_then_train(spark, tmp_out):
    raw = read_raw_trips(spark, SF001)
    raw.write.option("header", True).csv(f"{tmp_out}/raw")
    preprocess.main(["--input", f"{tmp_out}/raw", "--output", f"{tmp_out}/out"])
    funnel = read_result_csv(spark, f"{tmp_out}/out/data_summary", FUNNEL_SCHEMA).orderBy("step").collect()
    assert [r.rows for r in funnel] == [1000, 995, 735, 717, 717]
    sample = spark.read.option("header", True).csv(f"{tmp_out}/out/cleaned_sample")
    clean = spark.read.parquet(f"{tmp_out}/out/clean_parquet")
    assert [r.key for r in sample.collect()] == [r.key for r in ordered_sample(clean, 1000).collect()]

    summary, tables = train.run_train(spark, clean, f"{tmp_out}/train", profile="fast")
    assert summary.split["train"] + summary.split["test"] == 717
    ev = read_result_csv(spark, f"{tmp_out}/train/evaluation_result", EVALUATION_SCHEMA).collect()
    assert [r.model for r in ev] == [M.LINEAR, M.TREE, M.FOREST]
    assert summary.best == min(summary.evaluation, key=lambda e: e["rmse"])["model"]
    preds = spark.read.option("header", True).csv(f"{tmp_out}/train/prediction_sample")
    assert preds.count() == summary.split["test"]
    hist = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_out}/train/error_histogram")
    assert hist.agg(F.sum("n")).first()[0] == summary.split["test"]
    assert tables["prediction_sample"].count() == summary.split["test"]


def test_train_cli_saves_best_model(spark, tmp_out):
    raw = read_raw_trips(spark, SF001)
    pre = preprocess.run_preprocess(spark, raw, f"{tmp_out}/pre")
    train.main(["--input", pre.paths["clean_parquet"], "--output", f"{tmp_out}/t", "--save-best", "--split", "random"])
    saved = [p for p in __import__("os").listdir(f"{tmp_out}/t") if p.startswith("best_model_")]
    assert len(saved) == 1


def test_combined_full_profile_importances(spark, tmp_out):
    raw = read_raw_trips(spark, SF001)
    out = combined.run_combined(spark, raw, f"{tmp_out}/c", profile="full", save_best=False)
    assert len(out["evaluation"]) == 4
    funnel = read_result_csv(spark, f"{tmp_out}/c/data_summary_with_split", FUNNEL_SCHEMA).collect()
    assert len(funnel) == 7
    assert json.dumps(out, default=str)


def test_tree_wins_publishes_sorted_importances(spark, tmp_out):
    from meterline.operators.clean import clean_trips
    from meterline.plans.catalog import stepped_fares

    clean = stepped_fares(clean_trips(read_raw_trips(spark, SF001)))
    summary, _ = train.run_train(spark, clean, f"{tmp_out}/t", profile="full")
    assert summary.best in M.TREE_MODELS
    rows = [tuple(r) for r in read_result_csv(spark, summary.paths["feature_importance"], IMPORTANCE_SCHEMA).collect()]
    assert len(rows) == 10
    assert [v for _, v in rows] == sorted((v for _, v in rows), reverse=True)
    assert sum(v for _, v in rows) == pytest.approx(1.0)
    assert rows[0][0] == "trip_distance_km"


def test_train_needs_rows_on_both_sides(spark):
    from meterline.operators.clean import clean_trips

    clean = clean_trips(read_raw_trips(spark, SF001))
    one = clean.withColumn("key", F.lit("same key"))
    with pytest.raises(ValueError, match="both sides"):
        train.run_train(spark, one, None)


def test_constant_fare_still_gives_rmse(spark, tmp_out):
    from meterline.operators.clean import clean_trips

    clean = clean_trips(read_raw_trips(spark, SF001)).withColumn("fare_amount", F.lit(7.0))
    summary, tables = train.run_train(spark, clean, f"{tmp_out}/t")
    assert all(e["rmse"] is not None and e["r2"] is None for e in summary.evaluation)
    assert tables["error_histogram"].count() == 30


def test_sample_columns_with_timestamp(spark, tmp_out):
    from meterline.schemas import CLEAN_COLUMNS, SAMPLE_COLUMNS

    preprocess.main([
        "--input", f"{SF001}/events.parquet", "--format", "events", "--output", f"{tmp_out}/p", "--shuffle-partitions", "3",
        "--columns", ",".join([*CLEAN_COLUMNS, "pickup_timestamp"]), "--sample-columns", ",".join(SAMPLE_COLUMNS),
    ])
    assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    sample = spark.read.option("header", True).csv(f"{tmp_out}/p/cleaned_sample")
    assert sample.columns == SAMPLE_COLUMNS and sample.count() == 717


def test_publish_skips_absent_tables(spark, tmp_out):
    imp = spark.createDataFrame([("a", 0.25), ("b", 0.75)], IMPORTANCE_SCHEMA)
    written = publish_tables({"feature_importance": imp, "missing": None}, f"{tmp_out}/pub")
    assert list(written) == ["feature_importance"]
    back = read_result_csv(spark, written["feature_importance"], IMPORTANCE_SCHEMA)
    assert sorted(map(tuple, back.collect())) == [("a", 0.25), ("b", 0.75)]


@pytest.mark.parametrize("total,n", [(10, 1000), (717, 1000), (717, 100), (10**12, 1000)])
def test_bound_bits(total, n):
    b = bound_bits_for_total(total, n)
    assert 0 <= b <= 32
    assert b == 32 or total * 2**b >= 4 * n * 2**32


def test_known_total_sample_falls_back_when_bound_too_tight(spark, tmp_out):
    clean = read_raw_trips(spark, SF001).select("key")
    # Claim far more rows than exist: the first bound is too tight and must widen.
    first = bound_bits_for_total(10**9, 100)
    bits = write_ordered_sample(clean, 100, 10**9, f"{tmp_out}/s")
    got = [r.key for r in spark.read.option("header", True).csv(f"{tmp_out}/s").collect()]
    brute = [r.key for r in ordered_sample(clean, 100, prefilter=False).collect()]
    assert got == brute and bits > first


def test_preprocess_cli_reads_events_directly(spark, tmp_out, capsys):
    preprocess.main(["--input", f"{SF001}/events.parquet", "--format", "events", "--output", f"{tmp_out}/ev"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [out["counts"][k] for k in ("raw", "after_dropna", "after_domain_filter", "after_distance_filter", "final")] == [1000, 995, 735, 717, 717]
