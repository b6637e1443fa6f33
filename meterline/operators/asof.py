"""As-of join: each left row takes the latest right row of its key at or before its time.

Both sides are united and sorted, and a last-value window carries the right
rows forward: one exchange, no join. A key's time line is cut into buckets, so a
key that holds a large share of all rows is spread over tasks; each bucket gets
the latest right row before it as its first row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.ticks import ticks

# Rows of one key that one task may sort.
ROWS_PER_BUCKET = 1_000_000


def bucket_width(rows: DataFrame, keys: list[str], rows_per_bucket: int) -> int:
    """Ticks per bucket so that the busiest key, spread evenly, has ``rows_per_bucket`` rows in each; one row reaches the driver."""
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("tick").alias("low"), F.max("tick").alias("high"))
    n, low, high = per_key.agg(F.max("n"), F.min("low"), F.max("high")).first()
    if n is None or n <= rows_per_bucket:
        return (high - low if n else 0) + 1
    return max(1, (high - low + 1) * rows_per_bucket // n)


def _named(df: DataFrame, names: list[str]) -> list[Column]:
    return [df[f"`{n}`"] for n in names]


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, strict: bool = False, prefix: str = "right_", rows_per_bucket: int = ROWS_PER_BUCKET, width: int | None = None) -> DataFrame:
    """``left`` with the columns of ``right`` but its keys, named with ``prefix``; every left row stays.

    A right row fits if it has the same ``keys`` and its time is at or before
    the left row's (before it, if ``strict``). Of right rows with one time the
    greatest counts, by their other columns in order (null below any value).
    Rows without a key or time fit nothing: left ones get nulls, right ones are
    left out. Repeated left rows stay repeated. ``width`` (ticks per bucket)
    replaces the width that a pass over keys and times finds.
    """
    carried = [c for c in right.columns if c not in keys]
    if clash := {f"{prefix}{c}" for c in carried} & set(left.columns):
        raise ValueError(f"left columns {sorted(clash)} clash with prefix {prefix!r}")
    key_names = [f"key_{i}" for i in range(len(keys))]
    whole = lambda df, time: [c.isNotNull() for c in _named(df, [*keys, time])]

    def all_of(conditions: list[Column]) -> Column:
        out = conditions[0]
        for c in conditions[1:]:
            out = out & c
        return out

    def rows(df: DataFrame, time: str, side: int, own: Column, other: Column) -> DataFrame:
        at = df[f"`{time}`"]
        named = [c.alias(k) for c, k in zip(_named(df, keys), key_names)]
        return df.filter(all_of(whole(df, time))).select(*named, ticks(at, df.schema[time].dataType).alias("tick"), at.alias("at"), F.lit(side).alias("side"), own, other)

    left_row, right_row = F.struct(*_named(left, left.columns)), F.struct(right[f"`{right_time}`"].alias("at"), *(c.alias(f"c{i}") for i, c in enumerate(_named(right, carried))))
    left_kind = left.select(left_row.alias("x")).schema["x"].dataType
    right_kind = right.select(right_row.alias("x")).schema["x"].dataType
    ours = rows(left, left_time, 0 if strict else 2, left_row.alias("left_row"), F.lit(None).cast(right_kind).alias("right_row"))
    theirs = rows(right, right_time, 1, F.lit(None).cast(left_kind).alias("left_row"), right_row.alias("right_row"))
    both = ours.unionByName(theirs)
    width = width or bucket_width(both.select(*key_names, "tick"), key_names, rows_per_bucket)
    both = both.withColumn("bucket", F.expr(f"(tick - pmod(tick, {width}L)) div {width}L"))
    # The latest right row before each bucket: one row per key and bucket.
    held = both.groupBy(*key_names, "bucket").agg(F.max("right_row").alias("own"))
    before = Window.partitionBy(*key_names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    brought = held.withColumn("right_row", F.last("own", ignorenulls=True).over(before)).filter("right_row IS NOT NULL")
    brought = brought.select(*key_names, "bucket", F.col("right_row.at").alias("at"), F.lit(-1).alias("side"), F.lit(None).cast(left_kind).alias("left_row"), "right_row")
    line = both.drop("tick").unionByName(brought.select(*both.drop("tick").columns))
    order = Window.partitionBy(*key_names, "bucket").orderBy("at", "side", "right_row").rowsBetween(Window.unboundedPreceding, 0)
    matched = line.withColumn("found", F.last("right_row", ignorenulls=True).over(order)).filter("left_row IS NOT NULL")
    own = [F.col("left_row")[c].alias(c) for c in left.columns]
    out = matched.select(*own, *(F.col("found")[f"c{i}"].alias(f"{prefix}{c}") for i, c in enumerate(carried)))
    none = [F.lit(None).cast(right.schema[c].dataType).alias(f"{prefix}{c}") for c in carried]
    unfit = left.filter(~all_of(whole(left, left_time))).select(*_named(left, left.columns), *none)
    return out.unionByName(unfit)
