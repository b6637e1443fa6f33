"""The driver contract, and every SQL-backed query against DuckDB at sf0.001."""

import hashlib
import math
import re

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF001

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW_ML = {"linear_full", "dt_predictions", "rf_predictions", "gbt_predictions", "evaluation_fast", "evaluation_full", "feature_importance_dt", "model_reload_predictions", "dt_full_predictions", "rf_full_predictions"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 717
    assert "trip_distance_km" in df.columns


def _own(names):
    """Without the optional subpackage's queries, which are tested beside it."""
    return {n for n in names if not re.match(r"op\d+_|pipeline$", n)}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert _own(E.queries()) - _own(E.oracle_sql()) == SLOW_ML


@pytest.mark.parametrize("name", sorted(_own(E.oracle_sql())))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {n: str(t) for n, t in zip(dcols, [d[1] for d in res.description])}
    assert spark_types == duck_types
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
