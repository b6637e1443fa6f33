"""Structured Streaming ingest: raw CSV files -> clean Parquet + funnel log.

Plan per micro-batch (``foreachBatch``):

1. stage flags over the batch's raw rows (one projection);
2. the funnel counts observed during the clean write (one pass);
3. clean rows written under ``clean/batch_id=<id>`` and a one-row count
   record under ``funnel_batches/batch_id=<id>``. Both use dynamic partition
   overwrite, so a batch replayed after a failure replaces its own output.

The streaming checkpoint (``checkpointLocation``) records which files each
batch read. The running funnel is the per-stage sum of the batch records
(one row per batch), so no streaming state grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.clean import clean_from_flags, with_stage_flags
from meterline.operators.funnel import STAGES, observe_funnel, wide_to_funnel
from meterline.schemas import RAW_COLUMNS
from meterline.sources.readers import CSV_OPTIONS, csv_header, file_schema, project_named

BATCH_COUNTS_SCHEMA = T.StructType(
    [T.StructField("batch_id", T.LongType(), False)] + [T.StructField(s, T.LongType(), False) for s in STAGES]
)


def _write_batch(output_dir: str):
    base = output_dir.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        observed, obs = observe_funnel(with_stage_flags(batch), name=f"funnel_batch_{batch_id}")
        (
            clean_from_flags(observed)
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(f"{base}/clean")
        )
        counts = obs.get
        row = [(int(batch_id), *[int(counts[s]) for s in STAGES])]
        (
            spark.createDataFrame(row, BATCH_COUNTS_SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(f"{base}/funnel_batches")
        )

    return handle


def _has_files(spark: SparkSession, pattern: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(not s.isDirectory() or len(fs.listStatus(s.getPath())) > 0 for s in (fs.globStatus(path) or []))


def run_clean_stream(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
):
    """Start the ingest query. With ``available_now`` it processes every file
    present and stops (``awaitTermination`` returns); otherwise it keeps
    polling at ``processing_time``."""
    # Files already there give the column order; an empty folder expects the
    # usual one. A later file with another header fails its batch loudly.
    header = csv_header(spark, input_dir) if _has_files(spark, input_dir) else RAW_COLUMNS
    reader = spark.readStream.schema(file_schema(header)).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = project_named(reader.csv(input_dir))
    writer = raw.writeStream.foreachBatch(_write_batch(output_dir)).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def funnel_totals(spark: SparkSession, output_dir: str) -> DataFrame:
    """Running funnel: per-stage sums over the batch records -> (step, stage, rows)."""
    batches = spark.read.parquet(f"{output_dir.rstrip('/')}/funnel_batches")
    wide = batches.agg(*[F.sum(s).cast("bigint").alias(s) for s in STAGES])
    return wide_to_funnel(wide)


def main(argv=None) -> None:
    import argparse
    import json

    from meterline.session import get_session

    ap = argparse.ArgumentParser(description="clean raw trip CSV files as they arrive")
    ap.add_argument("--input", required=True, help="directory that receives raw trip CSV files")
    ap.add_argument("--output", required=True, help="output base (clean/, funnel_batches/)")
    ap.add_argument("--checkpoint", required=True, help="streaming checkpoint location on shared storage")
    ap.add_argument("--max-files-per-trigger", type=int, default=None)
    ap.add_argument("--every", default=None, help="keep running with this trigger interval, e.g. '1 minute'")
    args = ap.parse_args(argv)
    spark = get_session("meterline-stream")
    q = run_clean_stream(
        spark, args.input, args.output, args.checkpoint, args.max_files_per_trigger,
        available_now=args.every is None, processing_time=args.every,
    )
    q.awaitTermination()
    print(json.dumps({r["stage"]: r["rows"] for r in funnel_totals(spark, args.output).collect()}))


if __name__ == "__main__":
    main()
