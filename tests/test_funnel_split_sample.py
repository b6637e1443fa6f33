"""Funnel counts, hash split and the ordered sample."""

import duckdb
from pyspark.sql import functions as F

from meterline.functions.hashing import sample_order_key
from meterline.operators.clean import clean_trips
from meterline.operators.funnel import funnel_counts, funnel_labels
from meterline.operators.sample import ordered_sample
from meterline.operators.split import hash_split, split_counts, with_split_flag
from meterline.plans.preprocess import run_preprocess
from meterline.sources.fixtures import read_raw_trips

from .conftest import SF001

# Survivors measured in Spark and DuckDB on the driver's sf0.001 tables.
EXPECTED_SF001 = [1000, 995, 735, 717, 717]


def test_funnel_counts_sf0001(spark):
    rows = funnel_counts(read_raw_trips(spark, SF001)).orderBy("step").collect()
    assert [r.rows for r in rows] == EXPECTED_SF001
    assert [r.stage for r in rows] == ["raw", "after_dropna", "after_domain_filter", "after_distance_filter", "final"]


def test_funnel_with_split_adds_up(spark):
    rows = {r.stage: r.rows for r in funnel_counts(read_raw_trips(spark, SF001), with_split=True).collect()}
    assert rows["train"] + rows["test"] == rows["final"]
    labels = {r.stage: r.stage_label for r in funnel_labels(funnel_counts(read_raw_trips(spark, SF001), True)).collect()}
    assert labels["raw"] == "Raw data" and labels["train"] == "train"


def test_observed_funnel_equals_aggregate(spark, tmp_out):
    raw = read_raw_trips(spark, SF001)
    a = run_preprocess(spark, raw, f"{tmp_out}/a", funnel_mode="observe")
    b = run_preprocess(spark, raw, f"{tmp_out}/b", funnel_mode="aggregate")
    assert a.counts == b.counts
    assert [a.counts[k] for k in ["raw", "after_dropna", "after_domain_filter", "after_distance_filter", "final"]] == EXPECTED_SF001
    assert spark.read.parquet(a.paths["clean_parquet"]).count() == 717
    assert spark.read.option("header", True).csv(a.paths["cleaned_sample"]).count() == 717


def test_hash_split_is_partitioning_independent(spark):
    clean = clean_trips(read_raw_trips(spark, SF001))
    one = {r.key for r in hash_split(clean.coalesce(1))[0].collect()}
    many = {r.key for r in hash_split(clean.repartition(7))[0].collect()}
    assert one == many
    counts = {r.split: r.rows for r in split_counts(clean).collect()}
    assert counts["train"] == len(one) and counts["train"] + counts["test"] == 717


def test_hash_split_matches_duckdb(spark):
    clean = clean_trips(read_raw_trips(spark, SF001))
    got = {(r.key, r.split_bucket) for r in with_split_flag(clean).collect()}
    keys = [k for k, _ in got]
    con = duckdb.connect()
    con.execute("CREATE TABLE k(key VARCHAR)")
    con.executemany("INSERT INTO k VALUES (?)", [(k,) for k in keys])
    want = set(con.execute("SELECT key, CAST(('0x' || substr(md5(key), 1, 8)) AS BIGINT) % 100 FROM k").fetchall())
    assert got == want


def test_ordered_sample_equals_brute_force(spark):
    clean = clean_trips(read_raw_trips(spark, SF001))
    for n in (1, 10, 100, 717, 5000):
        fast = [r.key for r in ordered_sample(clean, n).collect()]
        brute = [r.key for r in clean.orderBy(sample_order_key("key"), "key").limit(n).collect()]
        assert fast == brute, n
        assert len(fast) == min(n, 717)


def test_ordered_sample_with_duplicate_keys(spark):
    # One key holds a third of the rows: the sample is still exact and whole.
    base = clean_trips(read_raw_trips(spark, SF001))
    hot = base.limit(1).select(*[F.col(c) for c in base.columns])
    skewed = base.unionByName(hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(360)))).drop("copy"))
    got = ordered_sample(skewed, 50).groupBy("key").count().collect()
    brute = skewed.orderBy(sample_order_key("key"), "key").limit(50).groupBy("key").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, brute))


def test_sample_is_the_same_in_any_layout_with_equal_keys(spark):
    rows = [(f"k{i % 7}", float(i), f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "key string, x double, note string")
    samples = [[tuple(r) for r in ordered_sample(d, 40).collect()] for d in (df.coalesce(1), df.repartition(5), df.repartition(9, "x").sortWithinPartitions("note"))]
    assert samples[0] == samples[1] == samples[2]
    assert len(samples[0]) == 40
