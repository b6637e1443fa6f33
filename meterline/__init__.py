"""meterline: Spark-native trip-fare preparation and regression.

Everything is a ``DataFrame -> DataFrame`` or ``Column -> Column`` step built
from built-in Spark SQL expressions and ``pyspark.ml`` estimators:

* ``functions``  – column expressions (haversine, time parsing, hashing, metrics)
* ``operators``  – table steps (validation, cleaning, funnel, split, sample,
  closed-form models, ML training, evaluation, report tables)
* ``sources``    – readers, writers and the test-data trip derivation
* ``plans``      – the batch jobs (preprocess, train, combined) wired from the above
* ``streaming``  – the same cleaning applied to files arriving in a directory
"""

from meterline.schemas import (  # noqa: F401
    CLEAN_COLUMNS,
    FEATURE_COLUMNS,
    RAW_COLUMNS,
    RAW_TRIP_SCHEMA,
)

__all__ = ["RAW_TRIP_SCHEMA", "RAW_COLUMNS", "CLEAN_COLUMNS", "FEATURE_COLUMNS"]
