"""Table contracts: column lists and StructTypes shared by every step."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw trip columns, in file order.
RAW_COLUMNS = [
    "key",
    "fare_amount",
    "pickup_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
]

# Explicit schema instead of CSV inference: inference turns a clean datetime
# column into a session-timezone timestamp and truncates timestamp-like keys.
RAW_TRIP_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("pickup_datetime", T.StringType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
    ]
)

TIME_COLUMNS = ["pickup_hour", "pickup_dayofweek", "pickup_month", "pickup_year"]

# Columns that must be present (not null, not NaN) after parsing.
DROPNA_SUBSET = [
    "fare_amount",
    "pickup_timestamp",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
]

# The clean table, in the order the model job expects; ``key``
# is kept (the reference drops it) so splits and samples are stable.
CLEAN_COLUMNS = [
    "key",
    "fare_amount",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
    "trip_distance_km",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_year",
]

# The clean sample of the one-job profile, 12 columns with the parsed time.
SAMPLE_COLUMNS = [
    "fare_amount",
    "pickup_timestamp",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
    "trip_distance_km",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_year",
]

# Model features, in vector order.
FEATURE_COLUMNS = [
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "trip_distance_km",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_year",
]

LABEL = "label"

# The 8 columns of the prediction sample, in order.
PREDICTION_SAMPLE_COLUMNS = [
    "label",
    "prediction",
    "trip_distance_km",
    "passenger_count",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_year",
]

FUNNEL_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("rows", T.LongType(), False),
    ]
)

EVALUATION_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
    ]
)

IMPORTANCE_SCHEMA = T.StructType(
    [T.StructField("feature", T.StringType(), False), T.StructField("importance", T.DoubleType())]
)
