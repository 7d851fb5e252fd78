"""Instalment / payment reconciliation as of a date.

Plan shape: payments are pre-aggregated per installment (partial + final hash
aggregate, so a hot installment never reaches one task as raw rows), then
joined to the current installments on the partitioning both already have. The
trusted-contract restriction comes last (an inner join with the unique trusted
contracts), so its contract_id partitioning carries on into the contract
position and the fact.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.columns import int_sum_if, record_hash
from ledgerloom.operators.dedupe import latest_per_key


def as_of_date(installments_raw: DataFrame, column: str = "snapshot_date") -> _dt.date:
    """The as-of date: the most recent snapshot (a one-row metric)."""
    return installments_raw.agg(F.max(column)).first()[0]


def _date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def latest_installments(installments_raw: DataFrame, order=None) -> DataFrame:
    """Newest version of each installment over all snapshots (``* EXCEPT`` the rank)."""
    order = order or ["snapshot_date", "ingested_at"]
    return latest_per_key(installments_raw, ["installment_id"], order)


def payment_totals(payments: DataFrame, as_of) -> DataFrame:
    """Paid amount, count and first/last date per installment, payments up to ``as_of``."""
    return (payments.where(F.col("payment_date") <= _date(as_of))
            .groupBy("installment_id")
            .agg(F.sum("amount_paid").cast(S.MONEY).alias("total_paid"),
                 F.count(F.lit(1)).alias("payment_count"),
                 F.min("payment_date").alias("first_payment_date"),
                 F.max("payment_date").alias("last_payment_date")))


def reconcile_installments(installments: DataFrame, contracts: DataFrame | None, payments: DataFrame,
                           as_of, paid_tolerance=S.PAID_TOLERANCE,
                           processed_at: bool = False) -> DataFrame:
    """Per installment: paid, outstanding, overpaid, days past due and status.

    ``installments``: current installment rows (one per id); ``contracts``:
    trusted contracts (one row per contract_id); ``payments``: trusted payments. Every output row is
    stamped with ``as_of`` as its ``snapshot_date``. With ``contracts=None`` installments of any
    contract are kept, for a caller that joins the contracts itself.
    """
    as_of_c = _date(as_of)
    totals = payment_totals(payments, as_of_c)
    # Totals first: both sides are already hash-partitioned by installment_id
    # (latest-row selection, payment aggregate), so this join adds no shuffle.
    # The trusted contracts (unique per contract_id: only rank-1 rows are
    # valid) come last as an inner join -- a semi-join would be pushed back
    # below the outer join by the optimizer -- and leave the rows partitioned
    # by contract_id for the contract position and the fact join.
    base = (installments
            .where((F.col("scheduled_amount") > 0) & F.col("due_date").isNotNull())
            .join(totals, "installment_id", "left"))
    if contracts is not None:
        base = base.join(contracts.select("contract_id"), "contract_id", "inner")
    paid = F.coalesce(F.col("total_paid"), F.lit(0))
    balance = F.col("scheduled_amount") - paid
    past_due = F.col("due_date") < as_of_c
    out = base.select(
        "installment_id", "contract_id", "installment_number", "due_date",
        F.col("scheduled_amount").cast(S.MONEY).alias("scheduled_amount"),
        paid.cast(S.MONEY).alias("total_paid"),
        F.greatest(balance, F.lit(0)).cast(S.MONEY).alias("outstanding_amount"),
        F.greatest(paid - F.col("scheduled_amount"), F.lit(0)).cast(S.MONEY).alias("overpaid_amount"),
        F.coalesce(F.col("payment_count"), F.lit(0)).cast("bigint").alias("payment_count"),
        "first_payment_date", "last_payment_date",
        F.when(past_due & (balance > 0), F.datediff(as_of_c, F.col("due_date")))
         .otherwise(F.lit(0)).cast("int").alias("days_past_due"),
        F.when(balance <= F.lit(paid_tolerance), F.lit(S.PAID))
         .when(past_due, F.lit(S.OVERDUE))
         .when(paid > 0, F.lit(S.PARTIALLY_PAID))
         .otherwise(F.lit(S.OPEN)).alias("installment_status"),
        as_of_c.alias("snapshot_date"),
    )
    out = out.withColumn("record_hash", record_hash(*S.INSTALLMENT_HASH))
    if processed_at:
        out = out.withColumn("silver_processed_at", F.current_timestamp())
    return out


def installment_status_summary(reconciled: DataFrame) -> DataFrame:
    return (reconciled.groupBy("installment_status")
            .agg(F.count(F.lit(1)).alias("installments"),
                 F.sum("outstanding_amount").cast("decimal(22,2)").alias("outstanding_amount")))


def installment_metrics(reconciled: DataFrame) -> DataFrame:
    """Post-publish gate metrics of the reconciled installments (one row)."""
    return reconciled.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("installment_id").alias("distinct_ids"),
        int_sum_if(F.col("outstanding_amount") < 0).alias("negative_balances"),
        int_sum_if(F.col("installment_status") == S.OVERDUE).alias("overdue_installments"),
        F.sum("scheduled_amount").cast("decimal(22,2)").alias("scheduled_amount"),
        F.sum("total_paid").cast("decimal(22,2)").alias("total_paid"),
        F.sum("outstanding_amount").cast("decimal(22,2)").alias("outstanding_amount"))
