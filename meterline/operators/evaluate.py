"""Evaluation: one-pass metrics, leaderboard and best model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.metrics import error_range_columns, regression_metric_columns
from meterline.schemas import EVALUATION_SCHEMA


def regression_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: rmse, mae, r2, from a single aggregate pass.

    Replaces three ``RegressionEvaluator`` calls (three scans).
    """
    return predictions.agg(*regression_metric_columns(label, prediction))


def metrics_dict(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> dict[str, float]:
    """RMSE, MAE, R² plus the error range and maxima, all from one pass."""
    row = predictions.agg(
        *regression_metric_columns(label, prediction), *error_range_columns(label, prediction)
    ).first()
    return {k: (float(v) if v is not None else None) for k, v in row.asDict().items()}


def evaluation_table(spark: SparkSession, rows: list[tuple[str, float, float, float]]) -> DataFrame:
    """(model, rmse, mae, r2) with a ``position`` column for stable ties.

    ``rows`` has one entry per trained model (at most four), so building
    it from driver values is bounded.
    """
    schema = T.StructType([*EVALUATION_SCHEMA.fields, T.StructField("position", T.IntegerType(), False)])
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


def leaderboard(evaluation: DataFrame) -> DataFrame:
    """Add the rank of each model per metric: RMSE and MAE ascending, R² descending.

    The window has no partition key; it runs over the evaluation table,
    which has one row per model.
    """
    order_col = F.col("position") if "position" in evaluation.columns else F.col("model")

    def rank(c):
        return F.rank().over(Window.orderBy(c, order_col))

    return evaluation.select(
        "model",
        "rmse",
        "mae",
        "r2",
        rank(F.col("rmse").asc()).alias("rank_rmse"),
        rank(F.col("mae").asc()).alias("rank_mae"),
        rank(F.col("r2").desc()).alias("rank_r2"),
    )


def best_model(evaluation: DataFrame) -> DataFrame:
    """The model with the lowest RMSE; an exact tie goes to the earlier model."""
    order_col = F.col("position") if "position" in evaluation.columns else F.col("model")
    by = F.struct(F.col("rmse"), order_col)
    return evaluation.filter(F.col("rmse").isNotNull()).agg(
        F.min_by("model", by).alias("model"),
        F.min_by("rmse", by).alias("rmse"),
        F.min_by("mae", by).alias("mae"),
        F.min_by("r2", by).alias("r2"),
    )
