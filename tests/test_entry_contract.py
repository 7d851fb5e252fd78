"""The driver contract: every query has an oracle except the declared rows-only ones."""
import re

import __spark_entry__ as E

def own(names):
    """Without the training-data queries, which come and go with their subpackage."""
    return {n for n in names if n != "pipeline" and not re.match(r"op[0-9]+_", n)}


def test_every_query_has_an_oracle():
    q, o = own(E.queries()), own(E.oracle_sql())
    assert o == q
    assert len(q) >= 62


def test_oracle_sql_is_plain_text():
    for name, sql in E.oracle_sql().items():
        assert isinstance(sql, str) and "SELECT" in sql.upper(), name


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir("/root/testdata/sf0.001"):
        return
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "dim_product", "scalar_dates"],
                         capture_output=True, text=True, env=env, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec) and rec["unit"] == "sec"
    assert set(rec["queries"]) == {"dim_product", "scalar_dates"} and rec["sf"] == 0.001
