"""The whole product on tables, from landing files, at sf0.001."""
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import medallion as MD
from ledgerloom.plans.book import CreditBook
from ledgerloom.sources import testdata as TD

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")
def test_run_all_and_rerun(spark, tmp_root):
    book = CreditBook(spark, SF)
    pr = book.payments_raw
    expected = {"products": 5, "contracts_raw": book.contracts_raw.count(),
                "contracts_valid": book.contracts.count(),
                "contracts_quarantine": book.contracts_quarantine.count(),
                "contracts_duplicated_ids": book.contracts_raw.groupBy("contract_id").count()
                .where("count > 1").count(),
                "contracts_invalid_principal": 0,
                "payments_null_ids": 0, "payments_rescued": 0,
                "payments_null_amounts": pr.where(F.col("amount_paid").isNull()).count(),
                "payments_duplicate_rows": pr.count() - pr.select("payment_id").distinct().count()}
    lake = MD.Lake(root=tmp_root, prefix="llt", today=TD.TODAY, expectations=expected)
    MD.setup(spark, lake)
    MD.write_landing_from_testdata(spark, SF, lake)
    out = MD.run_all(spark, lake, TD.AS_OF)
    assert out["bronze_batch"]["contracts_raw"] == expected["contracts_raw"]
    assert out["silver_contracts"]["valid"]["INSERT"] == expected["contracts_valid"]
    t = lambda n: spark.table(lake.t(*n.split(".")))
    assert t("gold.fact_credit_portfolio").count() == book.fact.count()
    # the latest-row selection over the landing file equals the in-memory book
    assert t("silver.installments").count() == book.installments.count()
    results = t("ops.data_quality_results")
    assert results.where(~F.col("passed")).count() == 0
    assert results.count() == 5 + 4   # fixed checks + the four count expectations the checks use
    ex = t("gold.vw_executive_portfolio").first()
    assert ex["contract_count"] == book.fact.count()
    log = {r["label"]: r["rows_added"] for r in t("ops.load_log").collect()}
    assert log[f"customers snapshot_date={TD.AS_OF}"] == book.customers_raw.count()
    assert log["contracts_raw new files"] == expected["contracts_raw"]
    # the dashboards read the published tables
    from ledgerloom.operators import portfolio as P
    from ledgerloom.plans.dashboard import DASHBOARDS, dashboard
    fact, kpis = t("gold.fact_credit_portfolio"), t("gold.portfolio_kpis")
    same = {"bucket_distribution": P.bucket_distribution(fact), "top_overdue_products": P.top_overdue_products(kpis),
            "risk_by_state": P.risk_by_state(kpis)}
    for name, df in same.items():
        sql = dashboard(spark, "llt", name)
        assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, df.select(*sql.columns).collect())), name
    assert dashboard(spark, "llt", "latest_quality").count() == results.count()
    assert set(DASHBOARDS) == {"executive", "bucket_distribution", "top_overdue_products", "risk_by_state",
                                  "latest_quality"}
    # re-running is safe: nothing new is loaded and every silver row is kept
    assert MD.load_bronze_batch(spark, lake) == {"products_raw": 0, "contracts_raw": 0}
    assert MD.load_bronze_payments(spark, lake) == 0
    again = MD.build_silver_contracts(spark, lake)
    assert again["valid"]["INSERT"] == again["valid"]["UPDATE"] == again["valid"]["DELETE"] == 0
    assert again["quarantine"]["UPDATE"] == again["quarantine"]["DELETE"] == 0
    # a wrong expectation stops the run at the step gate
    wrong = MD.Lake(root=tmp_root, prefix="llt", today=TD.TODAY, expectations={"products": 6})
    with pytest.raises(MD.StepGateError):
        MD.gate_steps(spark, wrong)


@pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")
def test_second_snapshot_cycle(spark, tmp_root):
    """A later snapshot of the same book: older slices stay, silver re-stamps
    every installment with the new as-of date, counts stay consistent."""
    import datetime as dt
    book = CreditBook(spark, SF)
    lake = MD.Lake(root=tmp_root, prefix="llc", today=TD.TODAY,
                   expectations={"contracts_valid": book.contracts.count()})
    MD.setup(spark, lake)
    MD.write_landing_from_testdata(spark, SF, lake)
    MD.run_all(spark, lake, TD.AS_OF)
    n_inst = spark.table(lake.t("silver", "installments")).count()
    second = dt.date(2000, 2, 1)
    MD.write_landing_from_testdata(spark, SF, lake, snapshot=second)
    MD.load_bronze_snapshots(spark, lake, second)
    snaps = {r["snapshot_date"]: r["rows"] for r in
             spark.table(lake.t("bronze", "installments_raw")).groupBy("snapshot_date")
             .agg(F.count("*").alias("rows")).collect()}
    assert set(snaps) == {TD.AS_OF, second} and snaps[TD.AS_OF] == snaps[second]
    counts = MD.build_silver_installments(spark, lake)
    assert counts["INSERT"] == 0 and counts["DELETE"] == 0 and counts["UPDATE"] == n_inst
    inst = spark.table(lake.t("silver", "installments"))
    assert {r[0] for r in inst.select("snapshot_date").distinct().collect()} == {second}
    MD.build_gold(spark, lake)
    assert spark.table(lake.t("gold", "fact_credit_portfolio")).count() == book.fact.count()
    MD.run_quality(spark, lake)
    latest = spark.table(lake.t("ops", "data_quality_results"))
    assert latest.where(~F.col("passed")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")
def test_known_defect_scenario(spark, tmp_root):
    """Three bad contracts and two bad payment events land in quarantine, nothing else moves."""
    import posixpath
    counts = {}
    for label, defects in (("clean", False), ("defects", True)):
        lake = MD.Lake(root=posixpath.join(tmp_root, label), prefix=f"lld{label}", today=TD.TODAY)
        MD.setup(spark, lake)
        MD.write_landing_from_testdata(spark, SF, lake, defects=defects)
        MD.run_all(spark, lake, TD.AS_OF, gate=False)
        t = lambda n: spark.table(lake.t(*n.split(".")))
        counts[label] = {n: t(n).count() for n in ("silver.contracts", "silver.contracts_quarantine",
                                                    "silver.payments", "silver.payments_quarantine",
                                                    "bronze.contracts_raw", "bronze.payments_raw")}
        if defects:
            q = {r["contract_id"]: list(r["error_codes"]) for r in t("silver.contracts_quarantine").collect()}
            assert "INVALID_PRINCIPAL_AMOUNT" in q[9_000_001] and "CUSTOMER_NOT_FOUND" in q[9_000_002]
            pq = [list(r["error_codes"]) for r in t("silver.payments_quarantine").collect()
                  if r["payment_id"] == "INVALID_NULL_AMOUNT"]
            assert pq and "INVALID_PAYMENT_AMOUNT" in pq[0]
    c, d = counts["clean"], counts["defects"]
    assert d["bronze.contracts_raw"] == c["bronze.contracts_raw"] + 3
    assert d["bronze.payments_raw"] == c["bronze.payments_raw"] + 2
    assert d["silver.contracts"] == c["silver.contracts"]
    assert d["silver.contracts_quarantine"] == c["silver.contracts_quarantine"] + 3
    assert d["silver.payments"] == c["silver.payments"]
    assert d["silver.payments_quarantine"] == c["silver.payments_quarantine"] + 2
