"""Driver contract: entry() smoke, registry consistency, and every batch query
equal to its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402
from shoreline.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["local", "isDay", "boaHora", "dia", "inicio", "fim"]
    assert df.count() == 41


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


BATCH = [n for n in catalog.queries() if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    srows, scols = rows_of(df.columns, df.collect())
    res = con.execute(entry.oracle_sql()[name])
    drows, dcols = rows_of([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert Counter(srows) == Counter(drows)


@pytest.mark.parametrize("name", ["beach_day", "all_beach_day", "calendar_week", "payload_daily_ingest"])
def test_results_do_not_depend_on_the_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = entry.queries()[name](spark, SF)
        srows, scols = rows_of(df.columns, df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    res = con.execute(entry.oracle_sql()[name])
    drows, dcols = rows_of([d[0] for d in res.description], res.fetchall())
    assert scols == dcols and Counter(srows) == Counter(drows)
