"""Driver contract: entry() smoke, and every registered query against its
DuckDB twin on the smallest scale factor (same compare as the driver)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "median_price" in df.columns and df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows, "no SQL twin: at least rows, its own test compares them"
        return
    rel = duck.sql(sql)
    cols = rel.columns
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    # same Arrow types column by column (a type-sensitive hash must agree too)
    got_t = {f.name: str(f.type) for f in df.toArrow().schema}
    want_t = {f.name: str(f.type) for f in duck.sql(sql).to_arrow_table().schema}
    assert got_t == want_t
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]
