"""Streaming ingest gives the batch funnel, and replays nothing twice."""

from meterline.operators.funnel import funnel_counts
from meterline.sources.fixtures import read_raw_trips
from meterline.streaming import funnel_totals, run_clean_stream

from .conftest import SF001


def test_stream_matches_batch(spark, tmp_out):
    raw = read_raw_trips(spark, SF001)
    inp, out, ckpt = f"{tmp_out}/in", f"{tmp_out}/out", f"{tmp_out}/ckpt"
    first, second = raw.filter("CAST(key AS BIGINT) < 400"), raw.filter("CAST(key AS BIGINT) >= 400")
    first.write.option("header", True).csv(f"{inp}/part1")
    q = run_clean_stream(spark, f"{inp}/*", out, ckpt)
    q.awaitTermination()
    second.write.option("header", True).csv(f"{inp}/part2")
    q = run_clean_stream(spark, f"{inp}/*", out, ckpt)
    q.awaitTermination()
    # A third run finds no new files and changes nothing.
    q = run_clean_stream(spark, f"{inp}/*", out, ckpt)
    q.awaitTermination()
    want = {r.stage: r.rows for r in funnel_counts(raw).collect()}
    got = {r.stage: r.rows for r in funnel_totals(spark, out).collect()}
    assert got == want
    assert spark.read.parquet(f"{out}/clean").count() == want["final"]


def test_stream_cli(spark, tmp_out, capsys):
    from meterline.streaming.ingest import main

    read_raw_trips(spark, SF001).write.option("header", True).csv(f"{tmp_out}/in")
    main(["--input", f"{tmp_out}/in", "--output", f"{tmp_out}/out", "--checkpoint", f"{tmp_out}/ckpt", "--max-files-per-trigger", "3"])
    assert '"final": 717' in capsys.readouterr().out
