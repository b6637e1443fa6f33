"""Readers. Paths are parameters: any Hadoop-FS URI (hdfs://, s3a://, file:)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.validate import MissingColumnsError
from meterline.schemas import RAW_TRIP_SCHEMA

CSV_OPTIONS = {"header": True, "mode": "PERMISSIVE", "nanValue": "NaN", "enforceSchema": False}


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the CSV under ``path``: one header line is read, no types are inferred."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def file_schema(header: list[str], schema: T.StructType = RAW_TRIP_SCHEMA) -> T.StructType:
    """How to read a CSV with this header: its columns in its order.

    Required columns keep their type, except integers, which are read as text
    (see ``project_named``); other columns are text and are dropped later.
    Raises listing every required column that the header lacks.
    """
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise MissingColumnsError(missing, "raw trip CSV")
    types = {f.name: f.dataType for f in schema.fields if not isinstance(f.dataType, T.IntegerType)}
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])


def project_named(df: DataFrame, schema: T.StructType = RAW_TRIP_SCHEMA) -> DataFrame:
    """Exactly the columns of ``schema``, by name.

    Whole numbers may be written as ``1`` or ``1.0``; other text gives null,
    like any malformed number, and cleaning drops the row.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType):
            number = F.trim(c).try_cast("double")
            c = F.when(number == F.floor(number), number.try_cast("int"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_TRIP_SCHEMA) -> DataFrame:
    """Raw trip CSV with a header; columns are matched by name, in any order.

    The header line of one file gives the order and must hold every column of
    ``schema`` (``MissingColumnsError`` before any scan). Spark then checks
    the header of every file against it (``enforceSchema`` off). No
    ``inferSchema``: it costs a full extra scan, and the types it picks depend
    on the data and on the session time zone.
    """
    as_written = file_schema(csv_header(spark, path), schema)
    return project_named(spark.read.schema(as_written).options(**CSV_OPTIONS).csv(path), schema)


def read_clean_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The clean trip table written by the preprocessing job."""
    return spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small published result table (funnel, evaluation, importances)."""
    return spark.read.schema(schema).option("header", True).csv(path)
