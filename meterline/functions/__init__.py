"""Column expressions. Every function returns a built-in Spark ``Column``
so it stays inside whole-stage codegen; there are no Python UDFs."""

from meterline.functions.geo import EARTH_RADIUS_KM, haversine_km  # noqa: F401
from meterline.functions.hashing import sample_order_key, split_bucket  # noqa: F401
from meterline.functions.metrics import regression_metric_columns  # noqa: F401
from meterline.functions.timeparts import (  # noqa: F401
    PICKUP_FORMAT,
    parse_pickup_timestamp,
    strip_zone_suffix,
    time_feature_columns,
)
