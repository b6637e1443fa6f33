"""Cross-validated ridge regression from one pass.

One aggregate gives every fold's counts, means and covariances. The moments of
the other folds are merged for each fold left out, every penalty is solved from
them, and the left-out fold's error follows from its own moments: rows are read
once, however many folds and penalties there are. The driver holds a matrix of
the features per fold, never rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold_of(key: str, folds: int) -> Column:
    """A stable fold from 0: other bits of ``md5(key)`` than the train/test split takes."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 9, 8), 16, 10).cast("bigint") % folds).cast("int")


@dataclass
class Moments:
    """Rows, means and population covariances of features and, last, the label."""

    rows: int
    mean: np.ndarray
    cov: np.ndarray

    def merged(self, other: Moments) -> Moments:
        rows = self.rows + other.rows
        gap = other.mean - self.mean
        spread = np.outer(gap, gap) * (self.rows / rows) * (other.rows / rows)
        cov = (self.rows * self.cov + other.rows * other.cov) / rows + spread
        return Moments(rows, self.mean + gap * (other.rows / rows), cov)


def fold_moments(df: DataFrame, features: list[str], label: str, fold: str) -> dict[int, Moments]:
    """Moments of each fold's complete rows, from one aggregate; a null or NaN leaves its row out."""
    named = [df[f"`{c}`"].cast("double").alias(f"x{i}") for i, c in enumerate([*features, label])]
    cols = [f"x{i}" for i in range(len(named))]
    rows = df.select(df[f"`{fold}`"].cast("int").alias("fold"), *named)
    complete = rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in cols], F.col("fold").isNotNull()))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)] + [F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]
    out = {}
    for r in complete.groupBy("fold").agg(F.count("*").alias("n"), *aggs).collect():  # one row per fold
        cov = np.empty((len(cols), len(cols)))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
        out[r["fold"]] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(len(cols))]), cov)
    return out


def solve_ridge(moments: Moments, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and intercept as ``LinearRegression(regParam=penalty)`` fits them with standardised features.

    A feature that does not vary gets weight 0, as does every one of a constant label.
    """
    sd = np.sqrt(np.maximum(np.diag(moments.cov), 0.0))
    spread, label_sd = sd[:-1], sd[-1]
    weights = np.zeros(len(spread))
    live = np.flatnonzero(spread > 0)
    if label_sd > 0 and len(live):
        corr = moments.cov[np.ix_(live, live)] / np.outer(spread[live], spread[live])
        right = moments.cov[live, -1] / (spread[live] * label_sd)
        left = corr + penalty / label_sd * np.eye(len(live))
        weights[live] = np.linalg.lstsq(left, right, rcond=None)[0] * label_sd / spread[live]
    return weights, float(moments.mean[-1] - weights @ moments.mean[:-1])


def mean_squared_error(moments: Moments, weights: np.ndarray, intercept: float) -> float:
    """The fit's mean squared error over the rows that ``moments`` describe."""
    direction = np.append(-weights, 1.0)
    bias = direction @ moments.mean - intercept
    return max(0.0, float(direction @ moments.cov @ direction + bias * bias))


def ridge_cv(df: DataFrame, features: list[str], penalties: list[float], label: str = "label", fold: str = "fold") -> DataFrame:
    """(penalty, fold, train_rows, test_rows, rmse, mean_mse, chosen), one row per penalty and fold.

    A fold is scored by the fit on all other folds. ``mean_mse`` is the mean
    over folds; ``chosen`` marks the penalty with the least (ties: the smaller
    penalty). With fewer than two folds there is nothing to fit or to score:
    no rows.
    """
    folds = fold_moments(df, features, label, fold)
    rows = []
    for k in sorted(folds) if len(folds) > 1 else []:
        rest = reduce(Moments.merged, (folds[j] for j in sorted(folds) if j != k))
        for penalty in penalties:
            mse = mean_squared_error(folds[k], *solve_ridge(rest, penalty))
            rows.append((float(penalty), k, rest.rows, folds[k].rows, mse))
    table = df.sparkSession.createDataFrame(rows, "penalty double, fold int, train_rows bigint, test_rows bigint, mse double")
    each = table.withColumn("mean_mse", F.avg("mse").over(Window.partitionBy("penalty")))
    best = F.min(F.struct("mean_mse", "penalty")).over(Window.partitionBy(F.lit(0)))
    return each.withColumn("chosen", best["penalty"] == F.col("penalty")).select("penalty", "fold", "train_rows", "test_rows", F.sqrt("mse").alias("rmse"), "mean_mse", "chosen")
