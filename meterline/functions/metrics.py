"""Regression metrics as aggregate expressions (one pass for all three)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def regression_metric_columns(label: str = "label", prediction: str = "prediction") -> list[Column]:
    """RMSE, MAE and R² over (label, prediction) as one aggregate.

    R² is ``1 - mean squared error / population variance of the label``,
    which equals ``1 - SS_res / SS_tot``; ``var_pop`` uses Spark's stable
    central-moment update, as the ML evaluator's summariser does. A constant
    label has no R² (null); the other two are still given.
    """
    err = F.col(label) - F.col(prediction)
    mse = F.avg(err * err)
    return [
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(F.col(label)))).alias("r2"),
    ]


def error_range_columns(label: str = "label", prediction: str = "prediction") -> list[Column]:
    """Extra aggregates for the same pass: the absolute-error range (histogram
    bounds) and the largest label and prediction (plot axis bound)."""
    err = F.abs(F.col(label) - F.col(prediction))
    return [
        F.min(err).alias("min_abs_error"),
        F.max(err).alias("max_abs_error"),
        F.max(F.col(label)).alias("max_label"),
        F.max(F.col(prediction)).alias("max_prediction"),
    ]
