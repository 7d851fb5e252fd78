import datetime as dt
from decimal import Decimal

from ledgerloom.operators import portfolio as P
from ledgerloom.operators import reconcile as R

AS_OF = dt.date(2000, 1, 1)
INST = "installment_id string, contract_id long, installment_number int, due_date date, scheduled_amount decimal(18,2)"
PAY = "installment_id string, payment_date date, amount_paid decimal(18,2)"


def test_status_dpd_and_boundaries(spark):
    inst = spark.createDataFrame([
        ("a", 1, 1, dt.date(1999, 12, 1), Decimal("100.00")),   # paid in full
        ("b", 1, 2, dt.date(1999, 12, 1), Decimal("100.00")),   # 0.01 left: PAID but DPD > 0
        ("c", 1, 3, dt.date(1999, 12, 1), Decimal("100.00")),   # partly paid, past due: OVERDUE
        ("d", 1, 4, AS_OF, Decimal("100.00")),                  # due on as-of: not overdue
        ("e", 1, 5, dt.date(2000, 2, 1), Decimal("100.00")),    # partly paid, future: PARTIALLY_PAID
        ("f", 2, 1, dt.date(1999, 12, 1), Decimal("50.00")),    # contract not trusted: dropped
        ("g", 1, 6, dt.date(2000, 2, 1), Decimal("0.00")),      # zero schedule: dropped
        ("h", 1, 7, dt.date(2000, 3, 1), Decimal("10.00")),     # overpaid
    ], INST)
    pays = spark.createDataFrame([
        ("a", dt.date(1999, 12, 1), Decimal("100.00")),
        ("b", dt.date(1999, 12, 1), Decimal("99.99")),
        ("c", dt.date(1999, 12, 1), Decimal("40.00")),
        ("c", AS_OF, Decimal("10.00")),                          # on as-of: counts
        ("c", dt.date(2000, 1, 2), Decimal("50.00")),           # after as-of: ignored
        ("e", dt.date(1999, 12, 5), Decimal("30.00")),
        ("h", dt.date(1999, 12, 5), Decimal("15.00")),
    ], PAY)
    contracts = spark.createDataFrame([(1,)], "contract_id long")
    out = {r["installment_id"]: r for r in R.reconcile_installments(inst, contracts, pays, AS_OF).collect()}
    assert set(out) == {"a", "b", "c", "d", "e", "h"}
    assert out["a"]["installment_status"] == "PAID" and out["a"]["days_past_due"] == 0
    assert out["b"]["installment_status"] == "PAID" and out["b"]["days_past_due"] == 31
    assert out["c"]["installment_status"] == "OVERDUE" and out["c"]["total_paid"] == Decimal("50.00")
    assert out["c"]["payment_count"] == 2 and out["c"]["last_payment_date"] == AS_OF
    assert out["d"]["installment_status"] == "OPEN" and out["d"]["days_past_due"] == 0
    assert out["e"]["installment_status"] == "PARTIALLY_PAID"
    assert out["h"]["overpaid_amount"] == Decimal("5.00") and out["h"]["outstanding_amount"] == Decimal("0.00")
    assert out["h"]["snapshot_date"] == AS_OF


def test_fact_buckets_and_kpis(spark):
    inst = spark.createDataFrame([
        (1, AS_OF, "PAID", Decimal("10.00"), Decimal("10.00"), Decimal("0.00"), 0, dt.date(1999, 1, 1)),
        (1, AS_OF, "OPEN", Decimal("10.00"), Decimal("0.00"), Decimal("10.00"), 0, dt.date(2000, 2, 1)),
        (2, AS_OF, "OVERDUE", Decimal("20.00"), Decimal("0.00"), Decimal("20.00"), 95, dt.date(1999, 9, 1)),
        (3, AS_OF, "OVERDUE", Decimal("20.00"), Decimal("5.00"), Decimal("15.00"), 30, dt.date(1999, 12, 1)),
    ], "contract_id long, snapshot_date date, installment_status string, scheduled_amount decimal(18,2), "
       "total_paid decimal(18,2), outstanding_amount decimal(18,2), days_past_due int, due_date date")
    contracts = spark.createDataFrame([
        (1, 10, 1, dt.date(1999, 1, 1), "ACTIVE", Decimal("100.00"), Decimal("0.2000"), 12),
        (2, 10, 1, dt.date(1999, 1, 1), "CLOSED", Decimal("300.00"), Decimal("0.1000"), 12),
        (3, 11, 2, dt.date(1999, 1, 1), "ACTIVE", Decimal("50.00"), Decimal("0.3000"), 12),
        (4, 11, 2, dt.date(1999, 1, 1), "ACTIVE", Decimal("50.00"), Decimal("0.3000"), 12),  # no installments
    ], "contract_id long, customer_id long, product_id int, contract_date date, contract_status string, "
       "principal_amount decimal(18,2), annual_interest_rate decimal(10,4), term_months int")
    fact = P.credit_portfolio_fact(contracts, P.contract_position(inst))
    f = {r["contract_id"]: r for r in fact.collect()}
    assert set(f) == {1, 2, 3}
    assert f[1]["delinquency_bucket"] == "CURRENT" and f[1]["next_due_date"] == dt.date(2000, 2, 1)
    assert f[2]["delinquency_bucket"] == "DPD_90_PLUS" and f[2]["is_npl_90"] is True
    assert f[3]["delinquency_bucket"] == "DPD_01_30" and f[3]["outstanding_ratio"] == Decimal("0.750000")
    cust = spark.createDataFrame([(10, "SP", "A"), (11, "RJ", "B")], "customer_id long, state string, risk_rating string")
    prod = spark.createDataFrame([(1, "P1"), (2, "P2")], "product_id int, product_name string")
    k = {r["product_id"]: r for r in P.portfolio_kpis(fact, cust, prod).collect()}
    assert k[1]["contract_count"] == 2 and k[1]["active_contract_count"] == 1
    # weighted rate = (100*0.2 + 300*0.1) / 400
    assert k[1]["weighted_average_interest_rate"] == Decimal("0.125000")
    assert k[1]["delinquency_ratio"] == Decimal("0.666667")  # 20 / 30
    ex = P.executive_portfolio(fact).collect()[0]
    assert ex["contract_count"] == 3 and ex["npl_90_amount"] == Decimal("20.00")
    top = P.top_overdue_products(P.portfolio_kpis(fact, cust, prod)).collect()
    assert [r["product_name"] for r in top] == ["P1", "P2"]
