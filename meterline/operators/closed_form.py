"""Closed-form models as aggregates: exact twins of ``pyspark.ml`` fits.

These are what ``pyspark.ml`` computes for small problems, written as one
aggregate pass each. Coefficients come back as a one-row struct through a
scalar subquery, so the scoring projection uses them as constants in the
same plan, with no driver round trip and no join.

* StandardScaler statistics: ``avg`` and ``stddev_samp``.
* OLS with one feature: ``regr_slope`` / ``regr_intercept``.
* Ridge (L2, standardised, ``LinearRegression(regParam=λ, elasticNetParam=0)``
  with the normal-equation solver): in standardised space the solution is
  ``(R + λ/σy·I) w̃ = r``, where R is the feature correlation matrix and
  r the feature-label correlations, all population moments. This gives
  closed forms for one and two features.
* Decision stump (``DecisionTreeRegressor(maxDepth=1)``) on features with
  few distinct values: candidate thresholds are midpoints of adjacent
  distinct values and the split maximises the variance gain. Spark ML
  considers the same candidates while a feature has at most ``maxBins``
  values and the binning sample holds all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators.project import with_columns_once


def _one_row_struct(df: DataFrame, fields: dict[str, Column]) -> Column:
    """Aggregate ``fields`` over ``df`` as one struct-valued scalar subquery."""
    return df.select(F.struct(*[c.alias(k) for k, c in fields.items()]).alias("s")).scalar()


# ------------------------------------------------------------------ scaler


def scaler_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean, std): column mean and sample standard deviation."""
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")).alias(f"m_{f}"), F.stddev_samp(F.col(f).cast("double")).alias(f"s_{f}")]
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f"m_{f}").alias("mean"), F.col(f"s_{f}").alias("std"))
        for i, f in enumerate(features)
    ]
    return wide.select(F.inline(F.array(*rows)))


def standardize(df: DataFrame, features: list[str], with_mean: bool = False, with_std: bool = True, suffix: str = "_scaled") -> DataFrame:
    """Add ``<f><suffix>`` per feature, as ``StandardScaler`` transforms.

    A zero standard deviation maps to 0.0 (as the ML scaler does). The
    statistics are one subquery, attached to each row once.
    """
    stats = {}
    for f in features:
        stats[f"m_{f}"] = F.avg(F.col(f).cast("double"))
        stats[f"s_{f}"] = F.stddev_samp(F.col(f).cast("double"))
    held = "_scaler"
    while held in df.columns:
        held = f"_{held}"
    s = F.col(held)
    out = {}
    for f in features:
        x = F.col(f).cast("double")
        if with_mean:
            x = x - s[f"m_{f}"]
        if with_std:
            std = s[f"s_{f}"]
            x = F.when(std != 0.0, x / std).otherwise(F.lit(0.0))
        out[f"{f}{suffix}"] = x
    return with_columns_once(df, {held: _one_row_struct(df, stats)}).withColumns(out).drop(held)


# ------------------------------------------------------------ linear fits


def correlation(a: Column, b: Column) -> Column:
    """Population correlation; null, not an error, if either side is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def linear_moments(y: str, xs: list[str]) -> list[Column]:
    """Every aggregate the linear fits below need, in one list.

    Each fit then reads its coefficients off one aggregate row, so several
    fits over the same rows share one pass.
    """
    Y = F.col(y)
    cols = [F.avg(Y).alias("m_y"), F.stddev_pop(Y).alias("s_y")]
    for x in xs:
        X = F.col(x)
        cols += [
            F.avg(X).alias(f"m_{x}"),
            F.stddev_pop(X).alias(f"s_{x}"),
            correlation(Y, X).alias(f"r_{x}"),
            F.regr_slope(Y, X).alias(f"b_{x}"),
            F.regr_intercept(Y, X).alias(f"a_{x}"),
        ]
    for i, a in enumerate(xs):
        for b in xs[i + 1 :]:
            cols.append(correlation(F.col(a), F.col(b)).alias(f"c_{a}__{b}"))
    return cols


def ols_terms(x: str) -> dict[str, Column]:
    """Least-squares line on one feature."""
    return {"slope": F.col(f"b_{x}"), "intercept": F.col(f"a_{x}")}


def ridge1_terms(x: str, reg: float) -> dict[str, Column]:
    """Standardised L2 regression on one feature: the OLS slope shrunk by 1 + λ/σy."""
    # A constant label (s_y = 0) has no shrinkage factor: nulls, not an error.
    slope = F.try_divide(F.col(f"b_{x}"), 1 + F.try_divide(F.lit(reg), F.col("s_y")))
    return {"slope": slope, "intercept": F.col("m_y") - slope * F.col(f"m_{x}")}


def ridge2_terms(x1: str, x2: str, reg: float) -> dict[str, Column]:
    """Standardised L2 regression on two features, solved in correlation space."""
    k = 1 + F.try_divide(F.lit(reg), F.col("s_y"))
    c, r1, r2 = F.col(f"c_{x1}__{x2}"), F.col(f"r_{x1}"), F.col(f"r_{x2}")
    det = k * k - c * c
    w1 = F.try_divide(F.try_divide(k * r1 - c * r2, det) * F.col("s_y"), F.col(f"s_{x1}"))
    w2 = F.try_divide(F.try_divide(k * r2 - c * r1, det) * F.col("s_y"), F.col(f"s_{x2}"))
    return {"w1": w1, "w2": w2, "intercept": F.col("m_y") - w1 * F.col(f"m_{x1}") - w2 * F.col(f"m_{x2}")}


def _fit(df: DataFrame, y: str, xs: list[str], terms: dict[str, Column]) -> DataFrame:
    return df.agg(*linear_moments(y, xs)).select(*[c.alias(n) for n, c in terms.items()])


def ols_1f(df: DataFrame, x: str, y: str = "label") -> DataFrame:
    """(slope, intercept) of the least-squares line."""
    return _fit(df, y, [x], ols_terms(x))


def ridge_1f(df: DataFrame, x: str, y: str = "label", reg: float = 0.1) -> DataFrame:
    """(slope, intercept) of standardised L2 regression on one feature."""
    return _fit(df, y, [x], ridge1_terms(x, reg))


def ridge_2f(df: DataFrame, x1: str, x2: str, y: str = "label", reg: float = 0.1) -> DataFrame:
    """(w1, w2, intercept) of standardised L2 regression on two features."""
    return _fit(df, y, [x1, x2], ridge2_terms(x1, x2, reg))


def linear_fits(df: DataFrame, x1: str, x2: str, y: str = "label", reg: float = 0.1) -> DataFrame:
    """OLS and ridge on ``x1`` plus ridge on (``x1``, ``x2``), from one aggregate pass.

    Columns: ``ols_*``, ``ridge1_*``, ``ridge2_*``.
    """
    terms = {}
    for prefix, t in (("ols", ols_terms(x1)), ("ridge1", ridge1_terms(x1, reg)), ("ridge2", ridge2_terms(x1, x2, reg))):
        terms.update({f"{prefix}_{k}": v for k, v in t.items()})
    return _fit(df, y, [x1, x2], terms)


def linear_predictions(df: DataFrame, coefs: DataFrame, features: list[str], weights: list[str]) -> DataFrame:
    """Score ``df`` with a one-row coefficient table (``weights`` + ``intercept``).

    The coefficients enter as a scalar subquery: computed once, no join.
    """
    held = "_coefs"
    while held in df.columns:
        held = f"_{held}"
    one = with_columns_once(df, {held: coefs.select(F.struct(*weights, "intercept").alias("s")).scalar()})
    pred = F.col(held)["intercept"]
    for f, w in zip(features, weights):
        pred = pred + F.col(held)[w] * F.col(f)
    return one.withColumn("prediction", pred).drop(held)


# ------------------------------------------------------------------ stump


def stump_candidates(df: DataFrame, features: list[str], y: str = "label") -> DataFrame:
    """Every midpoint split of every feature with its variance gain.

    One pass aggregates (feature, value) -> count, sum, sum of squares
    (combined map-side, so a value holding most rows costs one row per
    task). The cumulative window runs over that table, whose rows are the
    features' distinct values: hours, passenger counts and whole kilometres
    of a clean trip are bounded by the cleaning rules.
    """
    long = df.select(
        F.col(y).cast("double").alias("y"),
        F.inline(
            F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for i, f in enumerate(features)])
        ),
    )
    per_value = long.groupBy("position", "feature", "x").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss")
    )
    upto = Window.partitionBy("position").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("position")
    ordered = Window.partitionBy("position").orderBy("x")
    cum = per_value.select(
        "position",
        "feature",
        "x",
        F.lead("x").over(ordered).alias("next_x"),
        F.sum("n").over(upto).alias("ln"),
        F.sum("s").over(upto).alias("ls"),
        F.sum("ss").over(upto).alias("lss"),
        F.sum("n").over(whole).alias("tn"),
        F.sum("s").over(whole).alias("ts"),
        F.sum("ss").over(whole).alias("tss"),
    ).filter(F.col("next_x").isNotNull())

    # try_divide: Catalyst may evaluate these before the ``next_x`` filter
    # (the right side is empty on the last value), and ANSI mode raises on /0.
    def div(a, b):
        return F.try_divide(a, b)

    def variance(n, s, ss):
        return div(ss, n) - div(s, n) * div(s, n)

    rn, rs, rss = F.col("tn") - F.col("ln"), F.col("ts") - F.col("ls"), F.col("tss") - F.col("lss")
    gain = (
        variance(F.col("tn"), F.col("ts"), F.col("tss"))
        - div(F.col("ln"), F.col("tn")) * variance(F.col("ln"), F.col("ls"), F.col("lss"))
        - div(rn, F.col("tn")) * variance(rn, rs, rss)
    )
    return cum.select(
        "position",
        "feature",
        ((F.col("x") + F.col("next_x")) / 2).alias("threshold"),
        F.col("ln").cast("bigint").alias("left_n"),
        rn.cast("bigint").alias("right_n"),
        div(F.col("ls"), F.col("ln")).alias("left_mean"),
        div(rs, rn).alias("right_mean"),
        gain.alias("gain"),
    )


def tree_stump(df: DataFrame, features: list[str], y: str = "label") -> DataFrame:
    """The best single split; ties go to the earlier feature, then the lower threshold."""
    cands = stump_candidates(df, features, y)
    return (
        cands.filter(F.col("gain") > 0)
        .orderBy(F.col("gain").desc(), F.col("position"), F.col("threshold"))
        .limit(1)
        .drop("position")
    )
