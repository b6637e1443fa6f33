"""CSV input by header name: order, extra and missing columns, number spellings."""

import pytest
from pyspark.sql import functions as F

from meterline.operators.funnel import funnel_counts
from meterline.operators.validate import MissingColumnsError
from meterline.schemas import RAW_COLUMNS
from meterline.sources.fixtures import read_raw_trips
from meterline.sources.readers import read_raw_csv
from meterline.streaming import funnel_totals, run_clean_stream

from .conftest import SF001

FUNNEL = [1000, 995, 735, 717, 717]


def rows_of(df):
    return [r.rows for r in funnel_counts(df).orderBy("step").collect()]


def swapped(spark):
    return read_raw_trips(spark, SF001).withColumn("note", F.lit("x")).select("note", *RAW_COLUMNS[::-1])


def test_columns_are_matched_by_name(spark, tmp_out):
    raw = read_raw_trips(spark, SF001)
    swapped(spark).withColumn("passenger_count", F.col("passenger_count").cast("double")).write.option("header", True).csv(f"{tmp_out}/in")
    back = read_raw_csv(spark, f"{tmp_out}/in")
    assert back.columns == RAW_COLUMNS
    assert rows_of(back) == FUNNEL
    assert sorted(map(str, back.collect())) == sorted(map(str, raw.collect()))


def test_missing_columns_raise_before_any_scan(spark, tmp_out):
    read_raw_trips(spark, SF001).drop("passenger_count", "key").write.option("header", True).csv(f"{tmp_out}/in")
    with pytest.raises(MissingColumnsError, match="key.*passenger_count"):
        read_raw_csv(spark, f"{tmp_out}/in")


def test_files_with_another_header_fail(spark, tmp_out):
    raw = read_raw_trips(spark, SF001)
    raw.coalesce(1).write.option("header", True).csv(f"{tmp_out}/in/a")
    raw.select(*RAW_COLUMNS[::-1]).coalesce(1).write.option("header", True).csv(f"{tmp_out}/in/b")
    with pytest.raises(Exception, match="header"):
        read_raw_csv(spark, f"{tmp_out}/in/*").collect()


def test_passenger_text(spark, tmp_out):
    raw = read_raw_trips(spark, SF001).limit(6).coalesce(1)
    spelled = raw.withColumn("passenger_count", F.element_at(F.array(*map(F.lit, ["1", "2.0", " 3 ", "1.5", "many", "1e0"])), F.monotonically_increasing_id().cast("int") + 1))
    spelled.write.option("header", True).csv(f"{tmp_out}/in")
    got = sorted((r.passenger_count for r in read_raw_csv(spark, f"{tmp_out}/in").collect()), key=str)
    assert got == [1, 1, 2, 3, None, None]


def test_stream_reads_by_name(spark, tmp_out):
    swapped(spark).write.option("header", True).csv(f"{tmp_out}/in")
    run_clean_stream(spark, f"{tmp_out}/in", f"{tmp_out}/out", f"{tmp_out}/ckpt").awaitTermination()
    totals = {r.stage: r.rows for r in funnel_totals(spark, f"{tmp_out}/out").collect()}
    assert list(totals.values()) == FUNNEL
