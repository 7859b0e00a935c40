"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from nestmart.plans import registry
from nestmart.sources import TABLE_NAMES

from .conftest import SF_SMALL

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return (2, "nan" if math.isnan(f) else f"{f:.9g}")
    if isinstance(v, (dt.date, dt.datetime)):
        return (3, v.isoformat())
    return (4, str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """All but those of the training-data subpackage, whose tests hold the others."""
    assert set(registry.QUERIES) <= set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["id", "title", "release_date"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(cols, want)


@pytest.mark.parametrize("name", ["date_range", "year_filter", "question_b4", "incremental_ingest", "surrogate_key"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    saved = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert _canon(df.columns, got) == _canon(cols, cur.fetchall())
