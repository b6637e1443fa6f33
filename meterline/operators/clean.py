"""Trip cleaning: parse, drop incomplete rows, domain and distance filters,
time features.

Each rule is a predicate ``Column`` so the same rule serves two plans:

* ``clean_trips`` filters with the rules in sequence;
* ``with_stage_flags`` evaluates them as nested boolean columns so one
  aggregate (or one ``Observation`` during the Parquet write) counts every
  funnel stage in a single scan.

Range predicates on raw columns are plain comparisons, so Catalyst pushes
them into the Parquet/CSV scan; the distance rule is computed and stays a
``Filter`` inside the same whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.geo import haversine_km
from meterline.functions.timeparts import (
    parse_pickup_timestamp,
    strip_zone_suffix,
    time_feature_columns,
)
from meterline.operators.project import with_columns_once
from meterline.operators.validate import select_required
from meterline.schemas import CLEAN_COLUMNS, DROPNA_SUBSET, RAW_COLUMNS, TIME_COLUMNS

# The cleaning thresholds.
FARE_MIN_EXCLUSIVE = 0.0
FARE_MAX = 300.0
PASSENGERS_MIN_EXCLUSIVE = 0
PASSENGERS_MAX = 6
LONGITUDE_RANGE = (-75.0, -72.0)
LATITUDE_RANGE = (40.0, 42.0)
DISTANCE_MIN_EXCLUSIVE_KM = 0.0
DISTANCE_MAX_KM = 100.0

# Columns the reference's final all-column ``dropna`` sees; named explicitly
# so the projection stays prunable.
FINAL_COMPLETE_COLUMNS = [
    *RAW_COLUMNS,
    "pickup_datetime_clean",
    "pickup_timestamp",
    "trip_distance_km",
    *TIME_COLUMNS,
]

_FLOATING = (T.DoubleType, T.FloatType)


def present(df: DataFrame, columns: Iterable[str]) -> Column:
    """True where every column is non-null and, if floating, not NaN.

    Same rows as ``df.na.drop(subset=columns)``, as a reusable predicate.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    conds = []
    for c in columns:
        cond = F.col(c).isNotNull()
        if isinstance(types[c], _FLOATING):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    out = conds[0]
    for cond in conds[1:]:
        out = out & cond
    return out


def fare_passenger_predicate() -> Column:
    fare = F.col("fare_amount")
    pax = F.col("passenger_count")
    return (
        (fare > FARE_MIN_EXCLUSIVE)
        & (fare <= FARE_MAX)
        & (pax > PASSENGERS_MIN_EXCLUSIVE)
        & (pax <= PASSENGERS_MAX)
    )


def bbox_predicate() -> Column:
    """Both endpoints inside the inclusive longitude/latitude box."""
    lo_lon, hi_lon = LONGITUDE_RANGE
    lo_lat, hi_lat = LATITUDE_RANGE
    return (
        F.col("pickup_longitude").between(lo_lon, hi_lon)
        & F.col("dropoff_longitude").between(lo_lon, hi_lon)
        & F.col("pickup_latitude").between(lo_lat, hi_lat)
        & F.col("dropoff_latitude").between(lo_lat, hi_lat)
    )


def domain_predicate() -> Column:
    return fare_passenger_predicate() & bbox_predicate()


def trip_distance_expr() -> Column:
    return haversine_km("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def distance_predicate(distance: Column | None = None) -> Column:
    d = F.col("trip_distance_km") if distance is None else distance
    return (d > DISTANCE_MIN_EXCLUSIVE_KM) & (d <= DISTANCE_MAX_KM)


def final_complete_predicate() -> Column:
    """The all-column null/NaN drop, as it reduces after the earlier stages.

    By then the 7 parsed columns are present, the distance is a number in
    (0, 100] (NaN fails ``<= 100``), and the time parts of a non-null
    timestamp are non-null. So only ``key`` and the raw text can still be
    missing. Writing ``na.drop`` over all 16 columns would make Catalyst
    inline the timestamp parse into the filter once per derived column
    (about 9 parses per row); this keeps it at one. A test checks that the
    result equals the full drop.
    """
    return F.col("key").isNotNull() & F.col("pickup_datetime").isNotNull()


def with_pickup_time(df: DataFrame) -> DataFrame:
    """Add ``pickup_datetime_clean`` (suffix stripped) and ``pickup_timestamp``.

    The parse is the costliest expression per row. It is evaluated once,
    though the null check, the time features and the output all read it.
    """
    cleaned = with_columns_once(df, {"pickup_datetime_clean": strip_zone_suffix("pickup_datetime")})
    return with_columns_once(cleaned, {"pickup_timestamp": parse_pickup_timestamp("pickup_datetime_clean")})


def with_distance(df: DataFrame) -> DataFrame:
    """Add ``trip_distance_km``, evaluated once per row (two bounds and the output read it)."""
    return with_columns_once(df, {"trip_distance_km": trip_distance_expr()})


def with_time_features(df: DataFrame, ts: str = "pickup_timestamp") -> DataFrame:
    return df.withColumns(time_feature_columns(ts))


def drop_incomplete(df: DataFrame, subset: list[str] = DROPNA_SUBSET) -> DataFrame:
    """Null/NaN drop on the parsed columns (``key`` is not part of it)."""
    return df.na.drop(subset=subset)


def parsed_raw(raw: DataFrame) -> DataFrame:
    """Validate and project the 8 raw columns, then parse the pickup time."""
    return with_pickup_time(select_required(raw, RAW_COLUMNS, "raw trip table"))


def clean_stages(raw: DataFrame) -> dict[str, DataFrame]:
    """The cumulative surviving rows after each cleaning stage."""
    parsed = parsed_raw(raw)
    complete = drop_incomplete(parsed)
    domain = complete.filter(domain_predicate())
    distance = with_distance(domain).filter(distance_predicate())
    featured = with_time_features(distance)
    final = featured.filter(final_complete_predicate())
    return {
        "raw": parsed,
        "after_dropna": complete,
        "after_domain_filter": domain,
        "after_distance_filter": distance,
        "final": final,
    }


def clean_trips(raw: DataFrame, columns: list[str] = CLEAN_COLUMNS) -> DataFrame:
    """Raw trips -> the clean, model-ready table; ``columns`` may also name ``pickup_timestamp`` and the raw text."""
    return clean_stages(raw)["final"].select(*columns)


def with_stage_flags(raw: DataFrame) -> DataFrame:
    """Parsed raw rows plus nested stage flags, for one-pass counting.

    ``is_complete`` ⊇ ``in_domain`` ⊇ ``in_range`` ⊇ ``is_final``; the flags
    are never null. ``trip_distance_km`` is computed once per row and
    serves both the flag and the clean output.
    """
    parsed = with_distance(parsed_raw(raw))
    is_complete = F.coalesce(present(parsed, DROPNA_SUBSET), F.lit(False))
    in_domain = is_complete & F.coalesce(domain_predicate(), F.lit(False))
    in_range = in_domain & F.coalesce(distance_predicate(), F.lit(False))
    is_final = in_range & final_complete_predicate()
    return parsed.withColumns(
        {
            "is_complete": is_complete,
            "in_domain": in_domain,
            "in_range": in_range,
            "is_final": is_final,
        }
    )


def clean_from_flags(flagged: DataFrame, columns: list[str] = CLEAN_COLUMNS) -> DataFrame:
    """Rows of ``with_stage_flags`` that pass every stage, as ``columns``."""
    return with_time_features(flagged.filter(F.col("is_final"))).select(*columns)
