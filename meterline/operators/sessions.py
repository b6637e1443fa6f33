"""Sessions: rows of a key that follow each other without a long gap.

A key's time line is cut into buckets, as for the as-of join, and each bucket
finds its own sessions. Only a bucket's first and last can go on in another
bucket, so only these meet in one window per key; those between stay in their
bucket's own lane. A key that holds a large share of all rows is spread over
tasks, and no task holds more than a bucket's rows or a key's bucket edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.ticks import ticks
from meterline.operators.asof import ROWS_PER_BUCKET, bucket_width


def sessions(df: DataFrame, keys: list[str], time: str, gap: int, sums: dict[str, str] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET, width: int | None = None) -> DataFrame:
    """``keys``, ``session_start``, ``session_end``, ``rows`` and the ``sums`` (output name to column) of each session.

    Rows of one key belong together if no two neighbours in time are more than
    ``gap`` ticks apart (microseconds for times, days for dates, units for
    integers). Equal times and repeated rows all count. Rows without a key or
    time are in no session; an empty table has none. ``width`` (ticks per
    bucket) replaces the width that a pass over keys and times finds.
    """
    sums = sums or {}
    names = [*keys, "session_start", "session_end", "rows", *sums]
    if len(set(names)) < len(names):
        raise ValueError(f"output names are not unique: {names}")
    if gap < 0:
        raise ValueError("a gap is 0 or more")
    inner = [f"k{i}" for i in range(len(keys))]
    parts = [f"s{i}" for i in range(len(sums))]
    own = [df[f"`{k}`"].alias(n) for k, n in zip(keys, inner)]
    added = [df[f"`{c}`"].alias(n) for c, n in zip(sums.values(), parts)]
    at = df[f"`{time}`"]
    whole = reduce(lambda a, b: a & b, [df[f"`{k}`"].isNotNull() for k in keys], at.isNotNull())
    rows = df.filter(whole).select(*own, ticks(at, df.schema[time].dataType).alias("tick"), at.alias("at"), *added)
    width = width or bucket_width(rows.select(*inner, "tick"), inner, rows_per_bucket)
    rows = rows.withColumn("bucket", F.expr(f"(tick - pmod(tick, {width}L)) div {width}L"))

    line = Window.partitionBy(*inner, "bucket").orderBy("tick")
    opens = F.coalesce(F.col("tick") - F.lag("tick").over(line) > gap, F.lit(True)).cast("int")
    numbered = rows.withColumn("opens", opens).withColumn("no", F.sum("opens").over(line))
    local = numbered.groupBy(*inner, "bucket", "no").agg(
        F.min("tick").alias("low"), F.max("tick").alias("high"), F.min("at").alias("start"), F.max("at").alias("stop"), F.count("*").alias("n"), *[F.sum(p).alias(p) for p in parts]
    )
    last = F.max("no").over(Window.partitionBy(*inner, "bucket"))
    edge = (F.col("no") == 1) | (F.col("no") == last)
    # Bucket edges share the null lane of their key; the others cannot go on.
    laned = local.withColumn("lane", F.when(~edge, F.col("bucket")))

    chain = Window.partitionBy(*inner, "lane").orderBy("bucket", "no")
    opens = F.coalesce(F.col("low") - F.lag("high").over(chain) > gap, F.lit(True)).cast("int")
    joined = laned.withColumn("opens", opens).withColumn("whole", F.sum("opens").over(chain))
    out = joined.groupBy(*inner, "lane", "whole").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n").alias("n"), *[F.sum(p).alias(p) for p in parts])
    return out.select(
        *[F.col(n).alias(k) for n, k in zip(inner, keys)], F.col("start").alias("session_start"), F.col("stop").alias("session_end"), F.col("n").alias("rows"), *[F.col(p).alias(s) for p, s in zip(parts, sums)]
    )
