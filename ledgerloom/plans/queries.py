"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (through :mod:`ledgerloom.sources.testdata`)
and runs one operator of the library over them, whole. Outputs leave out
volatile columns (processing timestamps, random file names); arrays are
rendered as comma-joined strings so they can be value-hashed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import portfolio as P
from ledgerloom.operators import quality as Q
from ledgerloom.operators import reconcile as R
from ledgerloom.operators.dedupe import duplicate_keys, rank_duplicates
from ledgerloom.plans.book import CreditBook

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def joined(df: DataFrame, *cols: str) -> DataFrame:
    """Render array columns as comma-joined strings."""
    return df.withColumns({c: F.array_join(c, ",") for c in cols})


# --- gold ------------------------------------------------------------------

@query("executive_portfolio")
def q_executive(spark, sf):
    return P.executive_portfolio(CreditBook(spark, sf).fact)


@query("portfolio_kpis")
def q_kpis(spark, sf):
    return CreditBook(spark, sf).kpis


@query("credit_portfolio_fact")
def q_fact(spark, sf):
    return CreditBook(spark, sf).fact


@query("contract_position")
def q_position(spark, sf):
    return CreditBook(spark, sf).position


@query("delinquency_bucket")
def q_bucket(spark, sf):
    return CreditBook(spark, sf).fact.select("contract_id", "max_days_past_due", "delinquency_bucket",
                                             "is_npl_90", "outstanding_ratio")


@query("bucket_distribution")
def q_bucket_dist(spark, sf):
    return P.bucket_distribution(CreditBook(spark, sf).fact)


@query("top_overdue_products")
def q_top_overdue(spark, sf):
    return P.top_overdue_products(CreditBook(spark, sf).kpis)


@query("risk_by_state")
def q_risk_state(spark, sf):
    return P.risk_by_state(CreditBook(spark, sf).kpis)


@query("reconciliation_delta")
def q_recon_delta(spark, sf):
    b = CreditBook(spark, sf)
    return P.reconciliation_delta(b.installments, b.fact)


# --- silver: installments ----------------------------------------------------

@query("installments_reconciled")
def q_installments(spark, sf):
    return CreditBook(spark, sf).installments


@query("payment_totals")
def q_payment_totals(spark, sf):
    b = CreditBook(spark, sf)
    return R.payment_totals(b.payments, b.as_of)


@query("installment_status_summary")
def q_status_summary(spark, sf):
    return R.installment_status_summary(CreditBook(spark, sf).installments)


@query("installments_latest")
def q_inst_latest(spark, sf):
    return CreditBook(spark, sf).installments_latest


# --- silver: dimensions, dedupe ---------------------------------------------

@query("dim_customer")
def q_dim_customer(spark, sf):
    return CreditBook(spark, sf).dim_customer


@query("dim_product")
def q_dim_product(spark, sf):
    return CreditBook(spark, sf).dim_product


@query("duplicate_rank")
def q_duplicate_rank(spark, sf):
    b = CreditBook(spark, sf)
    ranked = rank_duplicates(b.contracts_raw, ["contract_id"], Q.CONTRACT_RANK_ORDER,
                             tie_cols=["customer_id", "product_id", "principal_amount", "term_months"])
    return ranked.select("contract_id", "customer_id", "principal_amount", "source_updated_at",
                         "duplicate_rank")


@query("batch_event_rank")
def q_batch_event_rank(spark, sf):
    """Position of every payment event within its delivery batch, latest first.

    All events share one batch id, so this key holds every row: the skew-safe
    path ranks it through a range-partitioned sort instead of one task.
    """
    p = CreditBook(spark, sf).payments_raw
    ties = ["payment_id", "installment_id", "contract_id", "installment_number", "payment_date",
            "amount_paid", "event_type"]
    ranked = rank_duplicates(p, ["source_batch_id"], ["event_timestamp"], tie_cols=ties,
                             out="batch_rank", strategy="sorted")
    return ranked.select("source_batch_id", *ties, "event_timestamp", "batch_rank")


@query("duplicate_keys")
def q_duplicate_keys(spark, sf):
    return duplicate_keys(CreditBook(spark, sf).contracts_raw, ["contract_id"])


# --- silver: classification --------------------------------------------------

CLASSIFIED_CONTRACT_COLS = [
    "contract_id", "customer_id", "product_id", "contract_date", "principal_amount",
    "annual_interest_rate", "term_months", "contract_status", "source_updated_at", "duplicate_rank",
    "matched_customer_id", "customer_type", "customer_snapshot_date", "matched_product_id",
    "allowed_customer_type", "max_term_months", "error_codes", "error_reasons"]

CLASSIFIED_PAYMENT_COLS = [
    "payment_id", "installment_id", "contract_id", "installment_number", "payment_date", "amount_paid",
    "event_type", "event_timestamp", "event_date", "duplicate_rank", "matched_installment_id",
    "expected_contract_id", "expected_installment_number", "error_codes", "error_reasons"]


@query("contracts_classified")
def q_contracts_classified(spark, sf):
    c = CreditBook(spark, sf).contracts_classified.select(*CLASSIFIED_CONTRACT_COLS)
    return joined(c, "error_codes", "error_reasons")


@query("contracts_valid")
def q_contracts_valid(spark, sf):
    return CreditBook(spark, sf).contracts


@query("contracts_quarantine")
def q_contracts_quarantine(spark, sf):
    return joined(CreditBook(spark, sf).contracts_quarantine, "error_codes", "error_reasons")


@query("payments_classified")
def q_payments_classified(spark, sf):
    c = CreditBook(spark, sf).payments_classified.select(*CLASSIFIED_PAYMENT_COLS)
    return joined(c, "error_codes", "error_reasons")


@query("payments_valid")
def q_payments_valid(spark, sf):
    return CreditBook(spark, sf).payments


@query("payments_quarantine")
def q_payments_quarantine(spark, sf):
    return joined(CreditBook(spark, sf).payments_quarantine, "error_codes", "error_reasons")


@query("error_code_counts")
def q_error_counts(spark, sf):
    b = CreditBook(spark, sf)
    c = Q.error_frequencies(b.contracts_classified).withColumn("dataset", F.lit("contracts"))
    p = Q.error_frequencies(b.payments_classified).withColumn("dataset", F.lit("payments"))
    return c.unionByName(p).select("dataset", "error_code", "occurrences")


@query("error_code_combinations")
def q_error_combinations(spark, sf):
    """Quarantined contracts per distinct combination of codes (in rule order)."""
    return Q.error_combinations(CreditBook(spark, sf).contracts_classified)
