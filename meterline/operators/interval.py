"""Interval joins as equi-joins on bins.

An axis is cut into bins as wide as the mean range: a point lies in one bin, and
a range is repeated in each bin that it touches, on average three times at most
whatever the ranges are. The bin is the join key and the exact bounds are a
residual condition, so no plan falls back to comparing all pairs; a bin that
many rows share is a skewed key, which adaptive execution splits.

Where only totals per range are asked for, ``range_totals`` lists no pairs: the
points' running totals hold from one point to the next, and each range looks up
the two that its bounds fall into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.ticks import ticks
from meterline.operators.asof import ROWS_PER_BUCKET, bucket_width

BIN = "bin_of_join"


def _tick(df: DataFrame, name: str) -> Column:
    return ticks(df[f"`{name}`"], df.schema[name].dataType)


def mean_width(ranges: DataFrame, start_col: str, end_col: str) -> int:
    """Ticks of the mean non-empty range, 1 at least; one number reaches the driver.

    With bins that wide, n ranges of total length n * width touch 3n bins or fewer.
    """
    length = (_tick(ranges, end_col) - _tick(ranges, start_col)).cast("double")
    found = ranges.select(length.alias("n")).filter("n >= 0").agg(F.avg("n")).first()[0]
    return max(1, int(found or 0))


def _bin(tick: Column, width: int) -> Column:
    """The bin's number, rounded down for negative ticks too; the division leaves no remainder."""
    return F.call_function("div", tick - F.pmod(tick, F.lit(width).cast("long")), F.lit(width).cast("long"))


def _binned(df: DataFrame, start_col: str, end_col: str, width: int) -> DataFrame:
    """``df`` once per bin that its range touches; rows with a missing bound or an end before the start vanish."""
    start, end = df[f"`{start_col}`"], df[f"`{end_col}`"]
    bins = F.sequence(_bin(_tick(df, start_col), width), _bin(_tick(df, end_col), width))
    return df.filter(start <= end).withColumn(BIN, F.explode(bins))


def _renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under names of its own, so that a table can be joined with itself; also old name -> new name."""
    names = {c: f"other_side_{i}" for i, c in enumerate(df.columns)}
    return df.select(*[df[f"`{c}`"].alias(n) for c, n in names.items()]), names


def _joined(left: DataFrame, right: DataFrame, names: dict[str, str], on: Column, keys: list[str], prefix: str) -> DataFrame:
    for k in keys:
        on = on & (left[f"`{k}`"] == right[names[k]])
    kept = [c for c in left.columns if c != BIN]
    other = [right[n].alias(f"{prefix}{c}" if c in kept else c) for c, n in names.items() if c not in keys]
    return left.join(right, (left[BIN] == right[BIN]) & on).select(*[left[f"`{c}`"] for c in kept], *other)


def point_in_range_join(points: DataFrame, ranges: DataFrame, point_col: str, start_col: str, end_col: str, keys: list[str] | None = None, closed: bool = False, width: int | None = None, prefix: str = "range_") -> DataFrame:
    """Every (point, range) pair with start <= point < end (``closed``: <= end) and equal ``keys``.

    Columns of ``ranges`` that clash get ``prefix``. Null points, bounds and keys
    and ranges that end before they start match nothing; repeated rows match
    repeatedly. An empty side gives no rows.
    """
    width = width or mean_width(ranges, start_col, end_col)
    other, names = _renamed(ranges)
    left = points.withColumn(BIN, _bin(_tick(points, point_col), width))
    right = _binned(other, names[start_col], names[end_col], width)
    at, start, end = left[f"`{point_col}`"], right[names[start_col]], right[names[end_col]]
    inside = (at >= start) & (at <= end if closed else at < end)
    return _joined(left, right, names, inside, keys or [], prefix)


def overlap_join(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str], keys: list[str] | None = None, width: int | None = None, prefix: str = "other_") -> DataFrame:
    """Every pair of ranges that share a point (bounds included) and equal ``keys``, each pair once.

    Both sides are repeated per bin; a pair is taken in the bin where the later
    of the two starts, so none is found twice. Null and backward ranges match
    nothing. ``width`` is the wider of the two sides' means.
    """
    width = width or max(mean_width(left, *left_bounds), mean_width(right, *right_bounds))
    other, names = _renamed(right)
    s2, e2 = (names[c] for c in right_bounds)
    one, two = _binned(left, *left_bounds, width), _binned(other, s2, e2, width)
    s1, e1 = (one[f"`{c}`"] for c in left_bounds)
    later = F.greatest(_tick(one, left_bounds[0]), _tick(two, s2))
    on = (s1 <= two[e2]) & (two[s2] <= e1) & (_bin(later, width) == one[BIN])
    return _joined(one, two, names, on, keys or [], prefix)


def _running_totals(points: DataFrame, point_col: str, values: list[str], rows_per_bucket: int) -> DataFrame:
    """One row per distinct tick: step_from, step_to (the next tick), and per total its value ``before_*`` the tick and ``through_*`` it.

    Totals run within buckets of ticks, and a bucket takes on what all earlier
    ones hold, so no task sorts the whole table. Decimals, since a total over
    everything may pass a long's range where each range's own does not.
    """
    at = points.filter(points[f"`{point_col}`"].isNotNull()).withColumn("tick", _tick(points, point_col))
    sums = {"n": F.count("*").cast("decimal(20,0)")}
    for i, v in enumerate(values):
        value = at[f"`{v}`"]
        sums |= {f"s{i}": F.coalesce(F.sum(value.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)"), f"m{i}": F.count(value).cast("decimal(20,0)")}
    own = at.groupBy("tick").agg(*[c.alias(k) for k, c in sums.items()])
    width = bucket_width(at.select("tick").distinct(), [], rows_per_bucket)
    own = own.withColumn("bucket", _bin(F.col("tick"), width))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = own.groupBy("bucket").agg(F.min("tick").alias("first"), *[F.sum(k).alias(k) for k in sums])
    held = held.select("bucket", F.lead("first").over(Window.orderBy("bucket")).alias("next_first"), *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"base_{k}") for k in sums])
    inside = Window.partitionBy("bucket").orderBy("tick")
    so_far = own.select("bucket", "tick", F.lead("tick").over(inside).alias("next"), *sums, *[F.sum(k).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"run_{k}") for k in sums])
    through = {k: F.col(f"base_{k}") + F.col(f"run_{k}") for k in sums}
    totals = [c for k, t in through.items() for c in ((t - F.col(k)).cast("decimal(38,0)").alias(f"before_{k}"), t.cast("decimal(38,0)").alias(f"through_{k}"))]
    return so_far.join(held, "bucket").select(F.col("tick").alias("step_from"), F.coalesce("next", "next_first", F.col("tick") + 1).alias("step_to"), *totals)


def range_totals(points: DataFrame, ranges: DataFrame, point_col: str, start_col: str, end_col: str, values: list[str], closed: bool = False, count_name: str = "n_points", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Each distinct range that holds a point, with the number of points in it and the sums of their ``values``.

    The same as ``point_in_range_join`` grouped by the range, but with two rows
    per range instead of one per pair, however many points a range holds.
    Bounds and points are times, dates or whole numbers, ``values`` whole
    numbers; a sum over nulls alone is null. Null points and bounds and
    backward ranges match nothing.
    """
    for df, c in [(points, point_col), (ranges, start_col), (ranges, end_col), *((points, v) for v in values)]:
        if isinstance(df.schema[c].dataType, (T.FractionalType, T.StringType)) or c in values and not isinstance(df.schema[c].dataType, T.IntegralType):
            raise TypeError(f"range_totals: {c} is {df.schema[c].dataType.simpleString()}")
    steps = _running_totals(points, point_col, values, rows_per_bucket)
    own = ranges.columns
    valid = ranges.filter(ranges[f"`{start_col}`"] <= ranges[f"`{end_col}`"]).distinct()
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.lit(False).alias("through"), _tick(valid, start_col).alias("bound")),
        F.struct(F.lit(1).alias("sign"), F.lit(closed).alias("through"), _tick(valid, end_col).alias("bound")),
    )
    # Past the last point its own totals hold; before the first there is nothing to find, which counts 0.
    last = F.col("last_step")
    both = valid.select(F.struct(*[valid[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(own)]).alias("range_row"), F.explode(sides).alias("side"))
    both = both.crossJoin(F.broadcast(points.agg(F.max(_tick(points, point_col)).alias("last_step"))))
    both = both.select("range_row", "side.sign", (F.col("side.through") | (F.col("side.bound") > last)).alias("whole"), F.least("side.bound", last).alias("bound"))
    found = point_in_range_join(both, steps, "bound", "step_from", "step_to")
    take = F.col("whole") | (F.col("bound") > F.col("step_from"))
    keys = ["n", *(f"{k}{i}" for i in range(len(values)) for k in "sm")]
    totals = found.groupBy("range_row").agg(*[F.sum(F.col("sign") * F.when(take, F.col(f"through_{k}")).otherwise(F.col(f"before_{k}"))).alias(k) for k in keys])
    summed = [F.when(F.col(f"m{i}") > 0, F.col(f"s{i}")).cast("long").alias(v) for i, v in enumerate(values)]
    return totals.filter("n > 0").select(*[F.col("range_row")[f"c{i}"].alias(c) for i, c in enumerate(own)], F.col("n").cast("long").alias(count_name), *summed)
