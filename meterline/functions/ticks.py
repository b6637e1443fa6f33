"""Whole-number ticks of an ordered column, for cutting it into buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

DAY_MICROS = 86_400_000_000


def ticks(value: Column, kind: DataType) -> Column:
    """Microseconds of a time, days of a date, the floor of a number: a long that never falls as ``value`` rises.

    A ``timestamp_ntz`` is read off its own fields, so no session zone can fold
    or skip an hour of it.
    """
    name = kind.typeName()
    if name == "timestamp_ntz":
        days = F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        minutes = F.hour(value).cast("long") * 60 + F.minute(value)
        return days * DAY_MICROS + minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), value) * 1_000_000).cast("long")
    if name == "timestamp":
        return F.unix_micros(value)
    if name == "date":
        return F.datediff(value, F.lit("1970-01-01").cast("date")).cast("long")
    return F.floor(value).cast("long")
