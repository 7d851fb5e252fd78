import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.columns import hash_bucket, hash_sample, record_hash
from ledgerloom.operators import checks as C
from ledgerloom.operators import pricing as PR


def test_expand_schedule_amounts_exact(spark):
    rows = [(1, dt.date(2000, 1, 31), Decimal("1000.00"), Decimal("0.2890"), 12),
            (2, dt.date(2000, 3, 15), Decimal("199999.99"), Decimal("0.3800"), 7),
            (3, dt.date(2000, 1, 1), Decimal("5.00"), Decimal("0.1000"), 0)]
    c = spark.createDataFrame(rows, "contract_id long, contract_date date, principal_amount decimal(18,2), "
                                    "annual_interest_rate decimal(10,4), term_months int")
    out = PR.expand_schedule(c).collect()
    assert len(out) == 19
    by = {r["installment_id"]: r for r in out}
    assert by["1-001"]["due_date"] == dt.date(2000, 2, 29)  # month-end clamp
    for cid, _, p, r, n in rows[:2]:
        want = (p * (1 + r * n / Decimal(12)) / n).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert by[f"{cid}-001"]["scheduled_amount"] == want


def test_price_contracts_and_defects(spark):
    contracts = spark.createDataFrame([(10, 1, 1, 60), (11, 2, 2, 12), (12, 3, 1, 12)],
                                      "contract_id long, customer_id long, product_id int, term_months int")
    cust = spark.createDataFrame([(1, "A"), (2, "E"), (3, "C")], "customer_id long, risk_rating string")
    prod = spark.createDataFrame([(1, Decimal("0.2890"), 48), (2, Decimal("0.1890"), 60)],
                                 "product_id int, base_annual_interest_rate decimal(10,4), max_term_months int")
    p = {r["contract_id"]: r for r in PR.price_contracts(contracts, cust, prod).collect()}
    assert p[10]["priced_rate"] == Decimal("0.2890") and p[10]["term_months"] == 48
    assert p[11]["priced_rate"] == Decimal("0.2890") and p[12]["priced_rate"] == Decimal("0.3240")
    full = spark.createDataFrame([(10, 1, Decimal("5.00")), (11, 2, Decimal("6.00")), (12, 3, Decimal("7.00"))],
                                 "contract_id long, customer_id long, principal_amount decimal(18,2)")
    out = PR.inject_defects(full, PR.standard_defects()).collect()
    assert len(out) == 6
    assert sorted(r["contract_id"] for r in out).count(10) == 2
    assert [r["principal_amount"] for r in out if r["contract_id"] == 9_000_001] == [Decimal("-500.00")]
    assert [r["customer_id"] for r in out if r["contract_id"] == 9_000_002] == [9_999_999]


def test_hashes_are_deterministic(spark):
    df = spark.range(1000).withColumn("b", hash_bucket(["id"], "salt", 10))
    again = spark.range(1000).repartition(7).withColumn("b", hash_bucket(["id"], "salt", 10))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))
    s1 = {r["id"] for r in hash_sample(spark.range(1000), ["id"], "paid", 50).collect()}
    s2 = {r["id"] for r in hash_sample(spark.range(1000).repartition(3), ["id"], "paid", 50).collect()}
    assert s1 == s2 and 350 < len(s1) < 650
    h = spark.createDataFrame([(1, None)], "a int, b string").select(record_hash("a", "b")).first()[0]
    h2 = spark.createDataFrame([(1,)], "a int").select(record_hash("a")).first()[0]
    assert h == h2   # NULL fields are left out of the hashed JSON


def test_checks_gate_and_latest_run(spark, tmp_root):
    import posixpath

    from ledgerloom import schemas as S
    from ledgerloom.sinks import tables as TB
    m = {"t": spark.createDataFrame([(5, 0)], "rows long, dups long")}
    checks = [C.Check("bronze", "t", "rows_is_5", "rows", 5), C.Check("bronze", "t", "no_dups", "dups", 0),
              C.Check("bronze", "t", "rows_is_6", "rows", 6, severity="WARN")]
    r1 = C.run_checks(spark, m, checks, "r1", dt.datetime(2000, 1, 1))
    got = {r["check_name"]: r["passed"] for r in r1.collect()}
    assert r1.count() == 3
    assert got == {"rows_is_5": True, "no_dups": True, "rows_is_6": False}
    name = "dq_" + posixpath.basename(tmp_root).replace("-", "_")
    TB.ensure_table(spark, name, S.QUALITY_RESULTS, "dq", location=posixpath.join(tmp_root, "dq"))
    assert C.publish_and_gate(r1, name) == 0          # WARN failure does not stop the run
    bad = [C.Check("silver", "t", "rows_is_7", "rows", 7)]
    r2 = C.run_checks(spark, m, bad, "r2", dt.datetime(2000, 1, 2))
    with pytest.raises(AssertionError):
        C.publish_and_gate(r2, name)
    assert spark.table(name).count() == 4             # persisted before the gate fired
    assert [r["run_id"] for r in C.latest_run(spark.table(name)).collect()] == ["r2"]


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, "a")], "payment_id int, amount_paid string")
    C.require_columns(df, ["payment_id"])
    with pytest.raises(C.SchemaContractError):
        C.require_columns(df, ["payment_id", "_rescued_data", "ingested_at"])
