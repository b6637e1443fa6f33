"""Tables behind the reference's charts (the charts themselves are not drawn)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators.sample import ordered_sample
from meterline.schemas import PREDICTION_SAMPLE_COLUMNS

DEFAULT_BINS = 30


def with_absolute_error(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predictions.withColumn("absolute_error", F.abs(F.col(label) - F.col(prediction)))


def error_histogram(
    predictions: DataFrame,
    bins: int = DEFAULT_BINS,
    label: str = "label",
    prediction: str = "prediction",
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width histogram of |label - prediction| over all predictions.

    The range comes from ``bounds`` when the caller already has it (the
    training job gets it from the metrics pass), else from one min/max pass
    (two numbers). Then one grouped count runs, with at most ``bins`` groups
    (map-side combined). Bins are half-open except the last, which holds the
    maximum, as in a plotting histogram. There are always ``bins`` rows: empty
    bins count 0, and without predictions the edges are null.
    """
    err = F.abs(F.col(label) - F.col(prediction))
    errs = predictions.select(err.alias("e"))
    if bounds is None:
        bounds = tuple(errs.agg(F.min("e"), F.max("e")).first())
    lo, hi = (F.lit(None if b is None else float(b)).cast("double") for b in bounds)
    width = (hi - lo) / bins
    b = F.when(hi > lo, F.least(F.floor((F.col("e") - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    empty = predictions.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), F.lit(0).cast("bigint").alias("n"))
    found = errs.select(b.cast("int").alias("bin"), F.lit(1).cast("bigint").alias("n"))
    counted = found.unionByName(empty).groupBy("bin").agg(F.sum("n").alias("n"))
    return counted.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_lo"),
        (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        "n",
    )


def axis_bound(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Upper bound of the actual-vs-predicted plot: the larger of both maxima."""
    return predictions.agg(F.greatest(F.max(label), F.max(prediction)).alias("axis_max"))


def prediction_sample(predictions: DataFrame, n: int = 1000, key: str = "key") -> DataFrame:
    """``key`` plus the 8 sample columns, for the n rows with the smallest md5(key)."""
    return ordered_sample(predictions.select(key, *PREDICTION_SAMPLE_COLUMNS), n, key)
