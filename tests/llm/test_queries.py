"""The registered queries: whole tables, DuckDB twins, and the pipeline against its stages."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from meterline.llm.catalog import ORACLE_SQL, QUERIES

from .test_decontaminate import bag, fold
from .test_decontaminate import brute as leaks
from .test_line_dedup import brute as deduped_lines
from .test_packing import assert_packed, want_pieces
from .test_quality import brute as judged
from .test_simhash import brute_components, brute_print

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(repr(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    df = QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    found = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in found.description]
    wanted = found.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(wanted)
    assert digest(df.columns, rows) == digest(cols, wanted)


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF001)
        assert out.columns == docs.columns, name
        path_rows = [tuple(r) for r in out.collect()]
        kept = spark.createDataFrame(path_rows, docs.schema)
    pieces = corpus_pipeline.run(spark, SF001)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in path_rows}
    again = corpus_pipeline.STAGES[-1][1](spark, kept, SF001)
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(pieces) == key(again)


def test_pipeline_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    good = [(i, t) for i, t in rows if judged(t)[-1]]
    lines = [(r[0], r[1]) for r in deduped_lines(good)]
    groups = brute_components([(i, brute_print(t)) for i, t in lines], 2)
    single = [(i, t) for (i, t), c in zip(lines, groups) if i == c]
    bags = {i: bag([w for w in fold(t) if w]).keys() for i, t in items}
    clean = []
    for i, t in single:
        own = bag([w for w in fold(t) if w]).keys()
        # Windows that share no shingle with an item cannot be similar to it.
        if not leaks([(i, t)], [(k, x) for k, x in items if bags[k] & own]):
            clean.append((i, t))
    assert len(rows) > len(good) > len(single) > len(clean) > 50
    got = corpus_pipeline.run(spark, SF001).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want_pieces(clean, 2048)
    assert_packed(got, 2048)
