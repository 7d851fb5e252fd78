"""The registered queries over the smallest tables, against their SQL where there is one."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare_oracle import TABLES, digest  # noqa: E402

from ledgerloom.llm.queries import LLM_ORACLE, LLM_QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(E.queries()) and set(LLM_ORACLE) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_query(spark, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in LLM_ORACLE:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cur = con.execute(LLM_ORACLE[name])
        cols = [d[0] for d in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert digest(df.columns, rows)[0] == digest(cols, cur.fetchall())[0]
