"""Dimensions, contract position, portfolio fact, KPIs and dashboards.

Scale notes
-----------
* ``contract_position`` is one hash aggregate by contract (partial + final).
* ``portfolio_kpis`` pre-aggregates the fact by (snapshot, product, customer)
  before the customer join, so the join input shrinks from one row per
  contract to one per customer/product pair; all measures are decomposable
  (sums, counts, max), including the weighted rate (sum of p*r and of p).
* The product dimension is broadcast only after a bounded row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.columns import guarded_ratio, int_sum_if
from ledgerloom.operators.dedupe import latest_per_key

SUM20 = "decimal(20,2)"
SUM22 = "decimal(22,2)"
RATIO = "decimal(12,6)"


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------

def silver_customers(customers_raw: DataFrame) -> DataFrame:
    """Latest *valid* row per customer."""
    c = F.col
    valid = (c("corrupt_record").isNull() & c("customer_id").isNotNull()
             & c("customer_type").isin(*S.CUSTOMER_TYPES)
             & c("risk_rating").isin(*S.RISK_RATINGS) & (c("monthly_income") > 0))
    latest = latest_per_key(customers_raw, ["customer_id"],
                            ["snapshot_date", "updated_at", "ingested_at"], where=valid)
    return latest.select("customer_id", "customer_type", "customer_name", "document_id", "email",
                         "state", "risk_rating", "monthly_income", "created_at", "updated_at",
                         "is_active", "snapshot_date", "source_system", "source_batch_id")


def silver_products(products_raw: DataFrame) -> DataFrame:
    """Latest valid row per product (file modification time, then ingestion time)."""
    c = F.col
    valid = (c("product_id").isNotNull() & (c("base_annual_interest_rate") > 0)
             & (c("base_annual_interest_rate") <= 1) & (c("max_term_months") > 0)
             & c("allowed_customer_type").isin(*S.ALLOWED_CUSTOMER_TYPES))
    latest = latest_per_key(products_raw, ["product_id"],
                            ["source_file_modification_time", "ingested_at"], where=valid)
    return latest.select("product_id", "product_name", "allowed_customer_type",
                         "base_annual_interest_rate", "max_term_months", "source_batch_id")



def dim_customer(customers: DataFrame) -> DataFrame:
    """Analytical customer dimension: an allow-list projection without PII."""
    return customers.select("customer_id", "customer_type", "state", "risk_rating",
                            "monthly_income", "is_active", "snapshot_date")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "allowed_customer_type",
                           "base_annual_interest_rate", "max_term_months")


# ---------------------------------------------------------------------------
# Fact
# ---------------------------------------------------------------------------

TERMS = ["contract_id", "customer_id", "product_id", "contract_date", "contract_status", "principal_amount",
         "annual_interest_rate", "term_months"]


def contract_position(installments: DataFrame, *carried: str) -> DataFrame:
    """Counts, money sums, max DPD and next due date per (contract, snapshot).

    ``carried``: columns with one value per contract that the result keeps.
    Installments that arrive hash-partitioned by ``contract_id``, from a join
    with the contracts, are aggregated as they lie, without an exchange.
    """
    status = F.col("installment_status")
    return (installments.groupBy("contract_id", "snapshot_date", *carried).agg(
        F.count(F.lit(1)).alias("installment_count"),
        int_sum_if(status == S.PAID).alias("paid_installment_count"),
        int_sum_if(status == S.OVERDUE).alias("overdue_installment_count"),
        F.sum("scheduled_amount").cast(SUM20).alias("contractual_amount"),
        F.sum("total_paid").cast(SUM20).alias("total_paid"),
        F.sum("outstanding_amount").cast(SUM20).alias("outstanding_amount"),
        F.sum(F.when(status == S.OVERDUE, F.col("outstanding_amount")).otherwise(F.lit(0)))
         .cast(SUM20).alias("overdue_amount"),
        F.max("days_past_due").alias("max_days_past_due"),
        F.min(F.when(status.isin(S.OPEN, S.PARTIALLY_PAID), F.col("due_date"))).alias("next_due_date"),
    ))


def delinquency_bucket(max_dpd) -> F.Column:
    expr = None
    for bound, name in S.DELINQUENCY_BUCKETS:
        cond = (max_dpd == bound) if bound == 0 else (max_dpd <= bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(S.LAST_BUCKET))


def credit_portfolio_fact(contracts: DataFrame, position: DataFrame,
                          processed_at: bool = False) -> DataFrame:
    """One row per contract and snapshot: contract terms + position + risk flags.

    Contracts without installments drop out (inner join), as published.
    """
    return _fact(contracts.select(*TERMS).join(position, "contract_id", "inner"), processed_at)


def portfolio_fact(contracts: DataFrame, installments: DataFrame, processed_at: bool = False) -> DataFrame:
    """The fact of :func:`credit_portfolio_fact`, from the installments.

    They meet the contracts before they are aggregated: the one exchange by
    contract serves the join and the position, installments of other contracts
    are not aggregated, and the contracts are read once. (Installments of a
    contract lie in many partitions, so that aggregating them first would
    hardly shrink what is shuffled.)
    """
    j = installments.join(contracts.select(*TERMS), "contract_id", "inner")
    return _fact(contract_position(j, *TERMS[1:]), processed_at)


def _fact(j: DataFrame, processed_at: bool) -> DataFrame:
    dpd = F.col("max_days_past_due")
    out = j.select(
        "contract_id", "customer_id", "product_id", "snapshot_date", "contract_date",
        "contract_status", "principal_amount", "annual_interest_rate", "term_months",
        "installment_count", "paid_installment_count", "overdue_installment_count",
        "contractual_amount", "total_paid", "outstanding_amount", "overdue_amount",
        "max_days_past_due", "next_due_date",
        delinquency_bucket(dpd).alias("delinquency_bucket"),
        F.when(dpd > S.NPL_DAYS, F.lit(True)).otherwise(F.lit(False)).alias("is_npl_90"),
        guarded_ratio(F.col("outstanding_amount"), F.col("contractual_amount"),
                      "decimal(10,6)").alias("outstanding_ratio"),
    )
    return out.withColumn("gold_processed_at", F.current_timestamp()) if processed_at else out


# ---------------------------------------------------------------------------
# KPIs and dashboards
# ---------------------------------------------------------------------------

def _npl_amount(outstanding="outstanding_amount"):
    return F.when(F.col("is_npl_90"), F.col(outstanding)).otherwise(F.lit(0))


def portfolio_kpis(fact: DataFrame, customers: DataFrame, products: DataFrame,
                   processed_at: bool = False) -> DataFrame:
    """KPIs by snapshot x product x state x risk rating."""
    # 1) pre-aggregate to (snapshot, product, customer): decomposable partial measures
    pre = fact.groupBy("snapshot_date", "product_id", "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        int_sum_if(F.col("contract_status") == "ACTIVE").alias("n_active"),
        F.sum("principal_amount").alias("principal"),
        F.sum("contractual_amount").alias("contractual"),
        F.sum("total_paid").alias("paid"),
        F.sum("outstanding_amount").alias("outstanding"),
        F.sum("overdue_amount").alias("overdue"),
        F.sum(_npl_amount()).alias("npl"),
        F.sum(F.col("principal_amount") * F.col("annual_interest_rate")).alias("p_rate"),
        F.max("max_days_past_due").alias("max_dpd"),
    )
    cust = customers.select("customer_id", "state", "risk_rating")
    prod = products.select("product_id", "product_name")
    j = pre.join(cust, "customer_id", "inner").join(prod, "product_id", "inner")
    g = j.groupBy("snapshot_date", "product_id", "product_name", "state", "risk_rating")
    # Re-sum the partials and give each total the type a one-level SUM over
    # the fact would have, so the ratios round exactly as the published view.
    total = {
        "principal": F.sum("principal").cast("decimal(28,2)"),
        "outstanding": F.sum("outstanding").cast("decimal(30,2)"),
        "overdue": F.sum("overdue").cast("decimal(30,2)"),
        "p_rate": F.sum("p_rate").cast("decimal(38,6)"),
    }
    out = g.agg(
        F.sum("n").alias("contract_count"),
        F.sum("n_active").cast("bigint").alias("active_contract_count"),
        total["principal"].cast(SUM22).alias("principal_amount"),
        F.sum("contractual").cast(SUM22).alias("contractual_amount"),
        F.sum("paid").cast(SUM22).alias("total_paid"),
        total["outstanding"].cast(SUM22).alias("outstanding_amount"),
        total["overdue"].cast(SUM22).alias("overdue_amount"),
        F.sum("npl").cast(SUM22).alias("npl_90_amount"),
        guarded_ratio(total["overdue"], total["outstanding"], RATIO).alias("delinquency_ratio"),
        guarded_ratio(total["p_rate"], total["principal"], RATIO).alias("weighted_average_interest_rate"),
        F.max("max_dpd").alias("max_days_past_due"),
    )
    return out.withColumn("gold_processed_at", F.current_timestamp()) if processed_at else out


def _share(part: str, whole: str) -> str:
    """A ratio of two sums, 0 where the whole is 0."""
    return f"cast(CASE WHEN {whole} = 0 THEN 0 ELSE {part} / {whole} END AS {RATIO})"


_OWED, _NPL = "sum(outstanding_amount)", "coalesce(sum(outstanding_amount) FILTER (WHERE is_npl_90), 0)"

#: The executive totals, one SQL expression each: the DataFrame and the persistent view are built from these.
EXECUTIVE = {
    "contract_count": "count(*)",
    "principal_amount": f"cast(sum(principal_amount) AS {SUM22})",
    "total_paid": f"cast(sum(total_paid) AS {SUM22})",
    "outstanding_amount": f"cast({_OWED} AS {SUM22})",
    "overdue_amount": f"cast(sum(overdue_amount) AS {SUM22})",
    "npl_90_amount": f"cast({_NPL} AS {SUM22})",
    "delinquency_ratio": _share("sum(overdue_amount)", _OWED),
    "npl_90_ratio": _share(_NPL, _OWED),
}


def executive_portfolio(fact: DataFrame) -> DataFrame:
    """Executive totals per snapshot (the body of the executive view)."""
    return fact.groupBy("snapshot_date").agg(*[F.expr(sql).alias(name) for name, sql in EXECUTIVE.items()])


def create_executive_view(spark, view: str, fact: str) -> None:
    """Persist :func:`executive_portfolio` as a view over a fact table."""
    totals = ", ".join(f"{sql} AS {name}" for name, sql in EXECUTIVE.items())
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT snapshot_date, {totals} FROM {fact} GROUP BY snapshot_date")


def bucket_distribution(fact: DataFrame) -> DataFrame:
    """Contracts and balances per delinquency bucket (sums keep their natural type)."""
    return (fact.groupBy("snapshot_date", "delinquency_bucket")
            .agg(F.count(F.lit(1)).alias("contracts"),
                 F.sum("outstanding_amount").alias("outstanding_amount"),
                 F.sum("overdue_amount").alias("overdue_amount")))


def top_overdue_products(kpis: DataFrame) -> DataFrame:
    """Products ranked by overdue balance; ratio is NULL when nothing is outstanding."""
    out_sum = F.sum("outstanding_amount")
    return (kpis.groupBy("product_name")
            .agg(out_sum.alias("outstanding_amount"),
                 F.sum("overdue_amount").alias("overdue_amount"),
                 F.sum("npl_90_amount").alias("npl_90_amount"),
                 (F.sum("overdue_amount") / F.nullif(out_sum, F.lit(0))).alias("delinquency_ratio"))
            .orderBy(F.col("overdue_amount").desc()))


def risk_by_state(kpis: DataFrame) -> DataFrame:
    return (kpis.groupBy("state", "risk_rating")
            .agg(F.sum("contract_count").alias("contracts"),
                 F.sum("outstanding_amount").alias("outstanding_amount"),
                 F.sum("overdue_amount").alias("overdue_amount"))
            .orderBy(F.col("overdue_amount").desc()))


def reconciliation_delta(installments: DataFrame, fact: DataFrame) -> DataFrame:
    """|sum(scheduled) in silver - sum(contractual) in gold|, NULL sums as 0 (one row)."""
    gold_total = fact.agg(F.sum("contractual_amount").cast(SUM22)).scalar()
    both = installments.agg(F.sum("scheduled_amount").cast(SUM22).alias("silver_total"),
                            gold_total.alias("gold_total"))
    return both.select("silver_total", "gold_total",
                       F.abs(F.coalesce(F.col("silver_total"), F.lit(0))
                             - F.coalesce(F.col("gold_total"), F.lit(0))).cast(SUM22)
                        .alias("reconciliation_delta"))
