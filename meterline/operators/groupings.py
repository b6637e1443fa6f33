"""Grouping sets over a pre-aggregated table.

Spark's own grouping sets copy every input row once per set. Here the rows are
first combined, map-side too, to one per combination of dimensions (and of the
values to be counted once), and only those few are copied.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cube_sets(dims: list[str]) -> list[list[str]]:
    """Every subset of ``dims``, from all of them to none (the grand total)."""
    return [list(c) for k in range(len(dims), -1, -1) for c in combinations(dims, k)]


def rollup_sets(dims: list[str]) -> list[list[str]]:
    """All dimensions, then one fewer from the right, down to none."""
    return [dims[:k] for k in range(len(dims), -1, -1)]


def grouping_sets(df: DataFrame, dims: list[str], sets: list[list[str]], count: str = "rows", sums: dict[str, str] | None = None, distinct: dict[str, str] | None = None) -> DataFrame:
    """``dims``, ``grouping_id`` and the measures, one row per group of each set.

    ``count`` names the number of rows, ``sums`` and ``distinct`` map output
    names to columns to sum and to count distinct values of (nulls do not
    count). ``grouping_id`` has a bit per dimension, the first the highest, set
    where the set leaves the dimension out: it tells a null in the data from a
    total. A sum over nulls alone is null. An empty table gives no rows, the
    grand total included.
    """
    sums, distinct = sums or {}, distinct or {}
    names = [*dims, "grouping_id", count, *sums, *distinct]
    if len(set(names)) < len(names):
        raise ValueError(f"output names are not unique: {names}")
    if len({frozenset(s) for s in sets}) < len(sets):
        raise ValueError("a grouping set is given twice")
    if unknown := {d for s in sets for d in s} - set(dims):
        raise ValueError(f"sets name {sorted(unknown)}, which are no dimensions")
    own = [df[f"`{d}`"].alias(f"d{i}") for i, d in enumerate(dims)]
    once = [df[f"`{c}`"].alias(f"u{i}") for i, c in enumerate(distinct.values())]
    parts = [F.sum(df[f"`{c}`"]).alias(f"s{i}") for i, c in enumerate(sums.values())]
    fine = df.groupBy(*own, *once).agg(F.count("*").alias("n"), *parts)
    inner = [f"d{i}" for i in range(len(dims))]
    place = {d: f"d{i}" for i, d in enumerate(dims)}
    measures = [F.sum("n").alias(count)]
    measures += [F.sum(f"s{i}").alias(name) for i, name in enumerate(sums)]
    measures += [F.count_distinct(f"u{i}").alias(name) for i, name in enumerate(distinct)]
    out = fine.groupingSets([[place[d] for d in s] for s in sets], *inner).agg(F.grouping_id().alias("grouping_id"), *measures)
    return out.select(*[F.col(f"d{i}").alias(d) for i, d in enumerate(dims)], "grouping_id", count, *sums, *distinct)
