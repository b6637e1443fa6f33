"""Job 2: clean Parquet -> split -> models -> result tables.

Plan:

1. Read the clean table (Parquet, column-pruned to ``key`` + label + 10
   features) and split it by the stable hash of ``key``. This is a per-row
   filter: no sort and no shuffle.
2. Assemble the feature vector once. Persist train as (label, vector) and
   test as its rows plus the vector (``MEMORY_AND_DISK`` by default;
   ``DISK_ONLY``, or ``NONE`` to re-read the column-pruned Parquet on
   every pass, when the table outgrows the cluster's memory). Counting
   both (the split counts) fills the caches before any fit starts. Each
   model reads them several times. A lost executor's blocks are
   recomputed from the Parquet lineage, which is short.
3. Fit every model of the profile (Spark ML's distributed solvers), score
   the test rows and compute RMSE, MAE and R² in one aggregate per model.
   The fits are submitted concurrently (``parallelism``), so one model's
   driver-side steps overlap another's executor work.
   A failing model is recorded and the others go on (as in the reference).
   If every model fails, the job raises.
4. For the best model only: the 1000-row sample and the error histogram
   over *all* test predictions (one pass each). The histogram bounds and
   the plot axis bound come from the metrics pass. For tree models, add
   the feature importances.
5. Publish each table as one CSV file, concurrently (all are bounded: one
   row per model, 10 importances, 30 bins, 1000 sample rows). Optionally
   save the best pipeline; it starts from raw columns.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from meterline.operators import models as M
from meterline.operators.evaluate import leaderboard
from meterline.operators.report import error_histogram
from meterline.operators.split import hash_split, random_split, split_counts
from meterline.schemas import FEATURE_COLUMNS, PREDICTION_SAMPLE_COLUMNS
from meterline.session import checkpoint_dir
from meterline.sources.readers import read_clean_parquet
from meterline.operators.sample import ordered_sample, write_ordered_sample
from meterline.sources.sinks import model_path, publish_tables, save_pipeline_model


@dataclass
class TrainResult:
    evaluation: list[dict]
    best: str
    split: dict[str, int]
    failed: list[str] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)
    model_path: str | None = None


def split_frames(frame: DataFrame, method: str = "hash", train_percent: int = 80, seed: int = 42):
    if method == "hash":
        return hash_split(frame, train_percent)
    if method == "random":
        return random_split(frame, (train_percent / 100, 1 - train_percent / 100), seed)
    raise ValueError(f"unknown split method {method!r}")


def run_train(
    spark: SparkSession,
    clean: DataFrame,
    output_base: str | None,
    profile: str = "fast",
    split_method: str = "hash",
    storage_level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    save_best: bool = False,
    sample_rows: int = 1000,
    bins: int = 30,
    features: list[str] = FEATURE_COLUMNS,
    parallelism: int = 2,
) -> tuple[TrainResult, dict[str, DataFrame | None]]:
    """Train the profile's models; return a summary and the result tables.

    Tables are published under ``output_base`` when it is given. A split
    without training or test rows raises a ``ValueError`` before any fit.
    """
    checkpoint_dir(spark)  # the forest and the boosted trees checkpoint there
    frame = M.model_input(clean, features)
    train, test = split_frames(frame, split_method)
    # Assemble the feature vector once; every model pass then reads the
    # cached vectors instead of re-assembling rows. Train keeps only what
    # fitting needs.
    train = M.assembled(train, features, keep=["label"])
    test = M.assembled(test, features)
    if storage_level is not None:
        train = train.persist(storage_level)
        test = test.persist(storage_level)
    try:
        if storage_level is not None or split_method != "hash":
            # Counting the persisted frames fills both caches in the pass that
            # had to happen anyway, and before the concurrent fits start (so
            # they do not all compute the same uncached partitions at once).
            split = {"train": train.count(), "test": test.count()}
        else:
            split = {r["split"]: int(r["rows"]) for r in split_counts(frame).collect()}
        # Two numbers on the driver; the published table is built from them
        # instead of re-running the aggregate.
        if not split.get("train") or not split.get("test"):
            raise ValueError(f"the split needs rows on both sides, it has {split}")
        split_tbl = spark.createDataFrame(list(split.items()), "split string, rows bigint")

        results = M.train_all(
            M.model_specs(profile, features), train, test, parallelism=parallelism, pre_assembled=True
        )
        ok = M.successful(results)
        best = M.best_result(results)
        evaluation = M.results_table(spark, results)

        # Two passes read the best model's scores (histogram, sample); the
        # scoring is a projection over the persisted test rows, so it is
        # recomputed rather than cached.
        best_preds = M.prediction_frame(best).select("key", *PREDICTION_SAMPLE_COLUMNS)
        x = best.extras
        axis = spark.createDataFrame([(max(x["max_label"], x["max_prediction"]),)], "axis_max double")
        tables = {
            "evaluation_result": evaluation.orderBy("position").drop("position"),
            "leaderboard": leaderboard(evaluation).orderBy("rank_rmse"),
            "prediction_sample": None,
            "error_histogram": error_histogram(
                best_preds, bins, bounds=(x["min_abs_error"], x["max_abs_error"])
            ).orderBy("bin"),
            "axis_bound": axis,
            "feature_importance": M.ranked_importances(M.feature_importances(spark, best, features)),
            "split_counts": split_tbl,
        }
        paths = publish_tables(tables, output_base) if output_base else {}
        if output_base:
            # The test-row count is known, so the sample is one filtered top-k pass.
            path = f"{output_base.rstrip('/')}/prediction_sample"
            write_ordered_sample(best_preds, sample_rows, split.get("test", 0), path)
            paths["prediction_sample"] = path
            tables["prediction_sample"] = spark.read.schema(best_preds.schema).option("header", True).csv(path)
        else:
            tables["prediction_sample"] = ordered_sample(best_preds, sample_rows, prefilter=False)
        saved = None
        if save_best and output_base:
            saved = save_pipeline_model(best.model, model_path(f"{output_base.rstrip('/')}/best_model", best.name))
        summary = TrainResult(
            evaluation=[{"model": r.name, "rmse": r.rmse, "mae": r.mae, "r2": r.r2} for r in ok],
            best=best.name,
            split=split,
            failed=[r.name for r in results if not r.success],
            paths=paths,
            model_path=saved,
        )
        return summary, tables
    finally:
        # Returned tables stay valid after this: unpersisted frames are
        # recomputed from the Parquet lineage if read again.
        train.unpersist()
        test.unpersist()


def main(argv=None) -> None:
    from meterline.session import get_session

    ap = argparse.ArgumentParser(description="clean Parquet -> models -> result tables")
    ap.add_argument("--input", required=True, help="clean Parquet path written by the preprocess job")
    ap.add_argument("--output", required=True, help="output base directory")
    ap.add_argument("--profile", default="fast", choices=sorted(M.PROFILES))
    ap.add_argument("--split", default="hash", choices=["hash", "random"])
    ap.add_argument(
        "--storage-level", default="MEMORY_AND_DISK",
        help="persist level for train/test (e.g. DISK_ONLY), or NONE to re-read Parquet each pass",
    )
    ap.add_argument("--save-best", action="store_true")
    ap.add_argument("--parallelism", type=int, default=2, help="models fitted concurrently")
    ap.add_argument("--shuffle-partitions", default=None, help="shuffle width of the job")
    args = ap.parse_args(argv)
    spark = get_session("meterline-train", conf={"spark.sql.shuffle.partitions": args.shuffle_partitions} if args.shuffle_partitions else None)
    summary, _ = run_train(
        spark,
        read_clean_parquet(spark, args.input),
        args.output,
        profile=args.profile,
        split_method=args.split,
        storage_level=None if args.storage_level == "NONE" else getattr(StorageLevel, args.storage_level),
        save_best=args.save_best,
        parallelism=args.parallelism,
    )
    print(json.dumps(summary.__dict__, default=str))


if __name__ == "__main__":
    main()

