"""Every registered query against its DuckDB oracle on the smallest fixture."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from test_entry_contract import own  # noqa: E402
from compare_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")
@pytest.mark.parametrize("name", sorted(own(E.queries())))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) > 0
        return
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "contract_count" in df.columns
