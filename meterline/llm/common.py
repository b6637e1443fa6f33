"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import delete_path, scratch_path

# Rows per Arrow batch: texts average a few kB, so a batch stays in the low MBs
# (Spark's own byte limit per batch holds for very long texts).
ARROW_BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_batches(spark: SparkSession) -> None:
    """Bound the rows that one Arrow batch hands to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))


class Stored:
    """A table written to the shared checkpoint folder: cuts lineage, survives lost executors."""

    def __init__(self, df: DataFrame, name: str, **options):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.options(**options).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def release(self) -> None:
        """Delete the files; only for tables that no later plan reads."""
        delete_path(self.spark, self.path)


def stored(df: DataFrame, name: str) -> DataFrame:
    return Stored(df, name).df


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores in front until no column of ``df`` clashes."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``name``, evaluated once per row.

    A plain projection is merged into what reads it, and a lambda would then
    evaluate the whole expression again for each element of its array.
    """
    kept = [column(c) for c in df.columns if c != name]
    return df.select(*kept, F.inline(F.array(F.struct(value.alias(name)))))


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")
