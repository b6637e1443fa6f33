"""Deterministic raw trips derived from the ``events`` table.

The reference reads a CSV of real taxi trips; the test tables hold an
``events`` stream instead. This derivation turns every event into one raw
trip with planted defects (NaN and negative fares, malformed dates, points
outside the box, null and zero-length trips, passenger counts 0 and 7) so
every cleaning rule removes some rows. It is a pure projection of
``events``: no shuffle, and its size grows with the input.

Every integer remainder is cast to DOUBLE before arithmetic so Spark and the
DuckDB oracle compute the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.schemas import RAW_COLUMNS

def ntz_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a ``timestamp_ntz``, with no zone conversion.

    ``date_format`` first converts its input to a zoned timestamp in the
    session time zone, which moves wall-clock times that fall in a
    daylight-saving gap. The NTZ-to-string cast does not.
    """
    return F.substring(ts.cast("string"), 1, 19)


def _rem(e: Column, m: int) -> Column:
    return (e % m).cast("double")


def raw_trips_from_events(events: DataFrame) -> DataFrame:
    """``events(event_id, ts, value, ...)`` -> raw trip rows (8 columns)."""
    e = F.col("event_id")
    value = F.col("value")
    # Base point near midtown, spread 0.1 degree each way.
    lon0 = F.lit(-73.98) + (_rem(e * 7919, 1000) - 500) / 5000
    lat0 = F.lit(40.75) + (_rem(e * 104729, 1000) - 500) / 5000

    shifted = F.col("ts").cast("timestamp_ntz") - F.make_dt_interval((e % 2500).cast("int"))
    pickup_text = F.concat(ntz_text(shifted), F.lit(" UTC"))

    cols = {
        "key": e.cast("string"),
        "fare_amount": F.when(e % 1009 == 5, F.lit(float("nan")))
        .when(e % 211 == 7, -value)
        .otherwise(F.lit(2.5) + value),
        "pickup_datetime": F.when(e % 499 == 3, F.lit("not a date")).otherwise(pickup_text),
        "pickup_longitude": F.when(e % 101 == 0, F.lit(0.0)).otherwise(lon0),
        "pickup_latitude": F.when(e % 101 == 0, F.lit(0.0))
        .when(e % 211 == 11, F.lit(40.1))
        .otherwise(lat0),
        "dropoff_longitude": F.when(e % 997 == 1, F.lit(None).cast("double"))
        .when(e % 53 == 0, lon0)
        .otherwise(lon0 + value / 1000),
        "dropoff_latitude": F.when(e % 211 == 11, F.lit(41.9))
        .when(e % 53 == 0, lat0)
        .otherwise(lat0 + (_rem(e, 5) - 2) / 200),
        "passenger_count": (e % 8).cast("int"),
    }
    # Emitted through a generator so that filters on the trip columns do not
    # inline (and re-run) these expressions; see operators.project.
    return events.select(F.inline(F.array(F.struct(*[cols[c].alias(c) for c in RAW_COLUMNS]))))


def read_raw_trips(spark, sf_dir: str) -> DataFrame:
    """Raw trips for a test-data directory (reads ``events.parquet``)."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("event_id", "ts", "value")
    return raw_trips_from_events(events)
