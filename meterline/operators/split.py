"""Train/test split.

Default: a stable hash split. A row trains when the first 32 bits of
``md5(key)`` mod 100 fall below the train percentage. It is a per-row
projection (no sort, no shuffle), and it gives the same rows however the
input is partitioned, and again after a task or executor is lost.

The reference's ``randomSplit([0.8, 0.2], seed=42)`` is kept as an option.
It sorts every partition on all columns and, with the same seed, still
gives different rows when the partition count changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.hashing import split_bucket
from meterline.operators.funnel import DEFAULT_TRAIN_PERCENT


def with_split_flag(df: DataFrame, train_percent: int = DEFAULT_TRAIN_PERCENT, key: str = "key") -> DataFrame:
    """Add ``split_bucket`` and ``is_train``."""
    b = split_bucket(key)
    return df.withColumns({"split_bucket": b, "is_train": b < train_percent})


def hash_split(
    df: DataFrame, train_percent: int = DEFAULT_TRAIN_PERCENT, key: str = "key"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) frames; both are filters over the same input."""
    b = split_bucket(key)
    return df.filter(b < train_percent), df.filter(b >= train_percent)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The reference's split, for comparison runs."""
    train, test = df.randomSplit(list(weights), seed=seed)
    return train, test


def split_counts(df: DataFrame, train_percent: int = DEFAULT_TRAIN_PERCENT, key: str = "key") -> DataFrame:
    """(split, rows) in one aggregate pass."""
    b = split_bucket(key)
    wide = df.agg(
        F.count_if(b < train_percent).alias("train"),
        F.count_if(b >= train_percent).alias("test"),
    )
    return wide.select(
        F.inline(
            F.array(
                F.struct(F.lit("train").alias("split"), F.col("train").cast("bigint").alias("rows")),
                F.struct(F.lit("test").alias("split"), F.col("test").cast("bigint").alias("rows")),
            )
        )
    )
