import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.operators import quality as Q

TODAY = dt.date(2000, 1, 1)
UPD = dt.datetime(2000, 1, 1, 7)


def contract(cid=1, cust=10, prod=1, date=dt.date(1999, 1, 1), principal="100.00", rate="0.2000", term=12,
             status="ACTIVE", upd=UPD):
    return (cid, cust, prod, date, None if principal is None else Decimal(principal),
            None if rate is None else Decimal(rate), term, status, upd, "SYS", "b1",
            "f.csv", "f.csv", dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1))


CONTRACT_RAW = ("contract_id long, customer_id long, product_id int, contract_date date, "
                "principal_amount decimal(18,2), annual_interest_rate decimal(10,4), term_months int, "
                "contract_status string, source_updated_at timestamp, source_system string, "
                "source_batch_id string, source_file_path string, source_file_name string, "
                "source_file_modification_time timestamp, ingested_at timestamp")


@pytest.fixture()
def dims(spark):
    customers = spark.createDataFrame(
        [(10, "PF", TODAY), (11, "PJ", TODAY)], "customer_id long, customer_type string, snapshot_date date")
    products = spark.createDataFrame(
        [(1, "PF", 24), (2, "PJ", 36), (3, "PF/PJ", 48)],
        "product_id int, allowed_customer_type string, max_term_months int")
    return customers, products


CASES = {
    "INVALID_CONTRACT_ID": contract(cid=-5),
    "NULL_CUSTOMER_ID": contract(cid=2, cust=None),
    "CUSTOMER_NOT_FOUND": contract(cid=3, cust=99),
    "NULL_PRODUCT_ID": contract(cid=4, prod=None),
    "PRODUCT_NOT_FOUND": contract(cid=5, prod=9),
    "INVALID_PRINCIPAL_AMOUNT": contract(cid=6, principal="-500.00"),
    "INVALID_INTEREST_RATE": contract(cid=7, rate="1.5000"),
    "INVALID_TERM": contract(cid=8, term=0),
    "TERM_EXCEEDS_PRODUCT_LIMIT": contract(cid=9, term=30),
    "CUSTOMER_TYPE_NOT_ALLOWED": contract(cid=10, cust=11, prod=1),
    "INVALID_CONTRACT_STATUS": contract(cid=11, status="PENDING"),
    "INVALID_CONTRACT_DATE": contract(cid=12, date=dt.date(2001, 1, 1)),
}


def classify(spark, dims, rows):
    raw = spark.createDataFrame(rows, CONTRACT_RAW)
    return {r["contract_id"]: list(r["error_codes"])
            for r in Q.classify_contracts(raw, *dims, today=TODAY).collect()}


def test_each_contract_rule_fires_alone(spark, dims):
    got = classify(spark, dims, list(CASES.values()) + [contract(cid=100)])
    for code, row in CASES.items():
        assert got[row[0]] == [code], code
    assert got[100] == []


def test_multiple_codes_in_rule_order_and_null_gaps(spark, dims):
    bad = contract(cid=0, cust=11, prod=1, principal=None, status="X", date=None)
    null_status = contract(cid=200, status=None)   # NULL status passes (three-valued NOT IN)
    dup_old = contract(cid=300, upd=dt.datetime(1999, 1, 1))
    dup_new = contract(cid=300)
    raw = spark.createDataFrame([bad, null_status, dup_old, dup_new], CONTRACT_RAW)
    out = Q.classify_contracts(raw, *dims, today=TODAY).collect()
    by = {(r["contract_id"], r["duplicate_rank"]): list(r["error_codes"]) for r in out}
    assert by[(0, 1)] == ["INVALID_CONTRACT_ID", "INVALID_PRINCIPAL_AMOUNT", "CUSTOMER_TYPE_NOT_ALLOWED",
                          "INVALID_CONTRACT_STATUS", "INVALID_CONTRACT_DATE"]
    assert by[(200, 1)] == []
    assert by[(300, 1)] == [] and by[(300, 2)] == ["DUPLICATE_CONTRACT_ID"]
    reasons = {r["contract_id"]: list(r["error_reasons"]) for r in out if r["duplicate_rank"] == 2}
    assert reasons[300] == [dict(S.CONTRACT_RULE_TEXTS)["DUPLICATE_CONTRACT_ID"]]


def test_rank_one_invalid_makes_valid_rank_two_a_duplicate(spark, dims):
    newer_invalid = contract(cid=400, principal="-1.00")
    older_valid = contract(cid=400, upd=dt.datetime(1999, 6, 1))
    c = Q.classify_contracts(spark.createDataFrame([newer_invalid, older_valid], CONTRACT_RAW), *dims,
                             today=TODAY)
    assert Q.contracts_valid(c).count() == 0
    q = Q.contracts_quarantine(c).collect()
    assert sorted(r["duplicate_rank"] for r in q) == [1, 2]
    assert len({r["quarantine_id"] for r in q}) == 2


PAYMENT_RAW = ("payment_id string, installment_id string, contract_id long, installment_number int, "
               "payment_date date, amount_paid decimal(18,2), event_type string, event_timestamp timestamp, "
               "source_system string, source_batch_id string, _rescued_data string, event_date date, "
               "source_file_path string, source_file_name string, source_file_modification_time timestamp, "
               "ingested_at timestamp")


def payment(pid="p1", inst="1-001", cid=1, num=1, amount="10.00", etype="PAYMENT", rescued=None,
            ts=dt.datetime(2000, 1, 1, 10), pdate=dt.date(2000, 1, 1)):
    return (pid, inst, cid, num, pdate, None if amount is None else Decimal(amount), etype, ts, "S", "b",
            rescued, TODAY, "p.json", "p.json", dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1))


def test_each_payment_rule(spark):
    inst = spark.createDataFrame(
        [("1-001", 1, 1, TODAY, dt.datetime(2000, 1, 1)), ("1-002", 1, 2, TODAY, dt.datetime(2000, 1, 1)),
         ("9-001", 9, 1, dt.date(1999, 1, 1), dt.datetime(1999, 1, 1))],
        "installment_id string, contract_id long, installment_number int, snapshot_date date, ingested_at timestamp")
    cases = {
        "INVALID_PAYMENT_ID": payment(pid="  "),
        "NULL_INSTALLMENT_ID": payment(pid="p3", inst=None),
        "INSTALLMENT_NOT_FOUND": payment(pid="p4", inst="9-001"),  # only in an older snapshot
        "CONTRACT_MISMATCH": payment(pid="p5", cid=2),
        "INSTALLMENT_NUMBER_MISMATCH": payment(pid="p6", num=3),
        "INVALID_PAYMENT_AMOUNT": payment(pid="p7", amount="0.00"),
        "INVALID_PAYMENT_DATE": payment(pid="p8", pdate=None),
        "INVALID_EVENT_TIMESTAMP": payment(pid="p9", ts=None),
        "INVALID_EVENT_TYPE": payment(pid="p10", etype="REFUND"),
        "RESCUED_SOURCE_DATA": payment(pid="p11", rescued='{"x":"1"}'),
    }
    rows = list(cases.values()) + [payment(pid="ok"), payment(pid="d", ts=dt.datetime(2000, 1, 2)),
                                   payment(pid="d"), payment(pid="nulltype", etype=None)]
    out = Q.classify_payments(spark.createDataFrame(rows, PAYMENT_RAW), inst).collect()
    got = {(r["payment_id"], r["duplicate_rank"]): list(r["error_codes"]) for r in out}
    for code, row in cases.items():
        assert got[(row[0], 1)] == [code], code
    assert got[("ok", 1)] == [] and got[("nulltype", 1)] == []
    assert got[("d", 1)] == [] and got[("d", 2)] == ["DUPLICATE_PAYMENT_ID"]


def test_error_frequencies(spark, dims):
    c = Q.classify_contracts(spark.createDataFrame(list(CASES.values()), CONTRACT_RAW), *dims, today=TODAY)
    freq = {r["error_code"]: r["occurrences"] for r in Q.error_frequencies(c).collect()}
    assert freq == {code: 1 for code in CASES}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="fixture tables not present")
def test_expectations_do_not_ask_the_classification(spark, monkeypatch):
    """A rule that rejects one sound contract fails the checks on valid and on rejected contracts."""
    from ledgerloom.operators import checks as C
    from ledgerloom.plans import queries_io as QI
    from ledgerloom.plans.book import CreditBook

    sf = "/root/testdata/sf0.001"
    expected = QI.expected_counts(spark, sf)
    victim = CreditBook(spark, sf).contracts.agg(F.min("contract_id")).first()[0]
    rules = Q.contract_rules
    monkeypatch.setattr(Q, "contract_rules", lambda today=None: [
        *rules(today), Q.Rule("WRONG", "wrong", F.col("contract_id") == victim)])
    book = CreditBook(spark, sf)
    metrics = {"contracts": C.profile(book.contracts), "contracts_quarantine": C.profile(book.contracts_quarantine)}
    checks = [c for c in QI.quality_checks(expected) if c.dataset in metrics]
    failed = C.run_checks(spark, metrics, checks, *QI.RUN_1).where(~F.col("passed")).count()
    assert len(checks) == 2 == failed
