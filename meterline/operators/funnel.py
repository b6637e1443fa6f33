"""Cleaning funnel: surviving rows per stage, counted in one scan.

The reference runs one ``count()`` per stage (five scans of the input).
Here every stage is a nested flag and all counts are ``count_if``
aggregates of a single pass: each task emits one partial row, and the
final merge is one row per task, whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterline.functions.hashing import split_bucket
from meterline.operators.clean import with_stage_flags

# Funnel stage ids in order, and the short chart labels.
STAGES = ["raw", "after_dropna", "after_domain_filter", "after_distance_filter", "final"]
SPLIT_STAGES = ["train", "test"]
STAGE_LABELS = {
    "raw": "Raw data",
    "after_dropna": "After dropna",
    "after_domain_filter": "Domain filter",
    "after_distance_filter": "Distance filter",
    "final": "Final data",
}

DEFAULT_TRAIN_PERCENT = 80


def funnel_aggregates(with_split: bool = False, train_percent: int = DEFAULT_TRAIN_PERCENT) -> list[Column]:
    """Aggregate expressions over ``with_stage_flags`` output, one per stage."""
    aggs = [
        F.count(F.lit(1)).alias("raw"),
        F.count_if(F.col("is_complete")).alias("after_dropna"),
        F.count_if(F.col("in_domain")).alias("after_domain_filter"),
        F.count_if(F.col("in_range")).alias("after_distance_filter"),
        F.count_if(F.col("is_final")).alias("final"),
    ]
    if with_split:
        bucket = split_bucket("key")
        aggs += [
            F.count_if(F.col("is_final") & (bucket < train_percent)).alias("train"),
            F.count_if(F.col("is_final") & (bucket >= train_percent)).alias("test"),
        ]
    return aggs


def _stages(with_split: bool) -> list[str]:
    return STAGES + (SPLIT_STAGES if with_split else [])


def wide_to_funnel(wide: DataFrame, with_split: bool = False) -> DataFrame:
    """One-row table of stage counts -> (step, stage, rows), one row per stage."""
    entries = [
        F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("stage"), F.col(name).cast("bigint").alias("rows"))
        for i, name in enumerate(_stages(with_split))
    ]
    return wide.select(F.inline(F.array(*entries)))


def funnel_counts(
    raw: DataFrame, with_split: bool = False, train_percent: int = DEFAULT_TRAIN_PERCENT
) -> DataFrame:
    """Raw trips -> (step, stage, rows) for 5 stages, or 7 with train/test."""
    wide = with_stage_flags(raw).agg(*funnel_aggregates(with_split, train_percent))
    return wide_to_funnel(wide, with_split)


def observe_funnel(flagged: DataFrame, name: str = "funnel") -> tuple[DataFrame, Observation]:
    """Attach the funnel counts as observed metrics of whatever action runs
    next on the returned frame (e.g. the clean Parquet write)."""
    obs = Observation(name)
    return flagged.observe(obs, *funnel_aggregates()), obs


def funnel_rows(counts: dict, with_split: bool = False) -> list[tuple[int, str, int]]:
    """Observed metric dict -> funnel rows (bounded: at most 7)."""
    return [(i + 1, name, int(counts[name])) for i, name in enumerate(_stages(with_split))]


def funnel_labels(funnel: DataFrame) -> DataFrame:
    """Add ``stage_label``: the short label, or the stage id when unmapped."""
    mapping = F.create_map(*[F.lit(x) for kv in STAGE_LABELS.items() for x in kv])
    return funnel.withColumn("stage_label", F.coalesce(mapping[F.col("stage")], F.col("stage")))
