"""Exact quantiles by refining histograms, with no sort.

A round counts the values of each open range in bins, combined map-side, and
goes on with the one bin that holds the wanted rank, between the least and the
greatest value found in it. Bins are equally wide in even rounds; in odd ones
they are so in the logarithm, of the value where the range holds both signs,
else of its distance from the end nearer to zero. Values of any scale part
fast: a double has 64 bits and a round settles about ten. Only bin counts leave
a task or reach the driver.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
# Types whose values a double holds exactly.
EXACT_TYPES = ("tinyint", "smallint", "int", "float", "double")


def quantile_rank(quantile: str | float, rows: int) -> int:
    """The rank, from 1, of the smallest value that at least this share of rows does not exceed."""
    return max(1, math.ceil(Fraction(str(quantile)) * rows))


def _bin(v: Column, low: float, high: float, bins: int, logarithmic: bool) -> Column:
    start, stop = F.lit(low), F.lit(high)
    # Halves, so that the width of the widest range is finite.
    width = stop / 2 - start / 2
    lost = 0.0
    if not logarithmic:
        share = F.try_divide(v / 2 - start / 2, width)
    elif low < 0 < high:
        # Both signs: equal widths in the exponent, which lies between -1075 and 1024.
        size = lambda x: (F.log2(x) + 1075) / 4200
        share = F.when(v > 0, 0.5 + size(v)).when(v < 0, 0.5 - size(-v)).otherwise(0.5)
    elif high <= 0:
        gap = F.try_divide(stop / 2 - v / 2, width)
        share, lost = -F.log2(F.when(gap > 0, gap)) / bins, 1.0
    else:
        gap = F.try_divide(v / 2 - start / 2, width)
        share = 1 + F.log2(F.when(gap > 0, gap)) / bins
    share = F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(lost))
    at = F.floor(F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)) * bins)
    # The ends always part, so every round gets further.
    return F.when(v == start, 0).when(v == stop, bins - 1).otherwise(F.least(at, F.lit(bins - 1))).cast("int")


def exact_quantiles(df: DataFrame, column: str, quantiles: list[str | float], bins: int = BINS) -> DataFrame:
    """(quantile, rank, value) for each of ``quantiles``, in their order: values that occur in ``column``.

    Nulls are left out; NaN is above every number, as in Spark's order. No
    values give null ranks and values. ``df`` is read once and then once a
    round, so it should be a stored table. Columns whose values a double cannot
    hold are refused.
    """
    kind = df.schema[column].dataType.simpleString()
    if kind not in EXACT_TYPES:
        raise TypeError(f"{column} is {kind}, not one of {', '.join(EXACT_TYPES)}")
    if bins < 2:
        raise ValueError("a round needs two bins or more")
    shares = [float(q) for q in quantiles]
    if not all(0 <= s <= 1 for s in shares):
        raise ValueError("quantiles lie between 0 and 1")
    spark = df.sparkSession
    values = df.select(df[f"`{column}`"].cast("double").alias("v")).filter("v IS NOT NULL")
    rows, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    found: dict[int, float] = {}
    ranks = [quantile_rank(q, rows) if rows else None for q in quantiles]
    # Open targets by range: (low, high) -> [(target, its rank inside the range)].
    ranges = {(low, high): list(enumerate(ranks))} if rows else {}
    round_no = 0
    while ranges:
        for ends in [e for e in ranges if e[0] == e[1] or math.isnan(e[0])]:
            found.update({target: ends[0] for target, _ in ranges.pop(ends)})
        if not ranges:
            break
        listed = list(ranges)
        place = number = None
        for i, ends in enumerate(listed):
            start, stop = F.lit(ends[0]), F.lit(ends[1])
            inside = (F.col("v") >= start) & (F.col("v") <= stop)
            here = _bin(F.col("v"), *ends, bins, round_no % 2 == 1)
            # Ranges are bins of earlier rounds, so a value lies in one at most.
            number = F.when(inside, i) if number is None else number.when(inside, i)
            place = F.when(inside, here) if place is None else place.when(inside, here)
        binned = values.select("v", number.alias("range"), place.alias("bin")).filter("range IS NOT NULL")
        counts = binned.groupBy("range", "bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        by_range: dict[int, list] = {}
        for r in counts.collect():  # at most a range per quantile, ``bins`` rows each
            by_range.setdefault(r["range"], []).append((r["bin"], r["n"], r["low"], r["high"]))
        narrowed: dict[tuple[float, float], list] = {}
        for i, ends in enumerate(listed):
            line = sorted(by_range[i])
            for target, rank in ranges[ends]:
                for _, n, bin_low, bin_high in line:
                    if rank <= n:
                        narrowed.setdefault((bin_low, bin_high), []).append((target, rank))
                        break
                    rank -= n
        ranges, round_no = narrowed, round_no + 1
    table = [(s, ranks[i], found.get(i)) for i, s in enumerate(shares)]
    return spark.createDataFrame(table, "quantile double, rank bigint, value double")
