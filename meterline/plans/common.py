"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUND_DIGITS = 6


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Round every floating column so two engines compare equal.

    ``+ 0.0`` turns a rounded negative zero into zero.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def ts_text(col: str, alias: str | None = None):
    """A ``timestamp_ntz`` as ``yyyy-MM-dd HH:mm:ss`` text, free of the session zone."""
    return F.substring(F.col(col).cast("timestamp_ntz").cast("string"), 1, 19).alias(alias or col)
