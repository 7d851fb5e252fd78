"""Rule-based classification into trusted and quarantined rows (Q1-Q8).

``classify`` evaluates an ordered list of rules on every row and attaches *all*
failing codes and reasons. Each predicate is evaluated once: the rules build an
array of ``struct(code, reason)`` (NULL when the rule passes), NULLs are
filtered out, and the two arrays are projected from it. It is one narrow
projection, so classification adds no shuffle of its own (the array filter
and transforms are evaluated per row outside codegen, once each).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.columns import quarantine_key, record_hash
from ledgerloom.operators.dedupe import latest_per_key, rank_duplicates
from ledgerloom.plans.joins import lookup_join


@dataclass(frozen=True)
class Rule:
    code: str
    reason: str
    fails: Column  # TRUE when the row breaks the rule; NULL counts as passing


def classify(df: DataFrame, rules: Sequence[Rule], codes: str = "error_codes",
             reasons: str = "error_reasons") -> DataFrame:
    errors = F.filter(
        F.array(*[F.when(r.fails, F.struct(F.lit(r.code).alias("code"),
                                           F.lit(r.reason).alias("reason")))
                  for r in rules]),
        lambda e: e.isNotNull())
    return (df.withColumn("_errors", errors)
              .withColumn(codes, F.transform("_errors", lambda e: e["code"]))
              .withColumn(reasons, F.transform("_errors", lambda e: e["reason"]))
              .drop("_errors"))


def _texts(table):
    return dict(table)


def _date_lit(today) -> Column:
    if today is None:
        return F.current_date()
    if isinstance(today, Column):
        return today
    if isinstance(today, str):
        today = _dt.date.fromisoformat(today)
    return F.lit(today)


def contract_rules(today=None) -> list[Rule]:
    """Contract rules in array order; ``today`` defaults to ``current_date()``."""
    t = _texts(S.CONTRACT_RULE_TEXTS)
    c = F.col
    allowed = c("allowed_customer_type")
    fails = {
        "DUPLICATE_CONTRACT_ID": c("duplicate_rank") > 1,
        "INVALID_CONTRACT_ID": c("contract_id").isNull() | (c("contract_id") <= 0),
        "NULL_CUSTOMER_ID": c("customer_id").isNull(),
        "CUSTOMER_NOT_FOUND": c("customer_id").isNotNull() & c("matched_customer_id").isNull(),
        "NULL_PRODUCT_ID": c("product_id").isNull(),
        "PRODUCT_NOT_FOUND": c("product_id").isNotNull() & c("matched_product_id").isNull(),
        "INVALID_PRINCIPAL_AMOUNT": c("principal_amount").isNull() | (c("principal_amount") <= 0),
        "INVALID_INTEREST_RATE": (c("annual_interest_rate").isNull()
                                  | (c("annual_interest_rate") <= 0)
                                  | (c("annual_interest_rate") > 1)),
        "INVALID_TERM": c("term_months").isNull() | (c("term_months") <= 0),
        "TERM_EXCEEDS_PRODUCT_LIMIT": (c("max_term_months").isNotNull()
                                       & (c("term_months") > c("max_term_months"))),
        "CUSTOMER_TYPE_NOT_ALLOWED": (c("matched_customer_id").isNotNull()
                                      & c("matched_product_id").isNotNull()
                                      & (allowed != F.lit(S.ANY_CUSTOMER_TYPE))
                                      & (allowed != c("customer_type"))),
        # NULL status passes (three-valued NOT IN), on purpose.
        "INVALID_CONTRACT_STATUS": ~c("contract_status").isin(*S.VALID_CONTRACT_STATUSES),
        "INVALID_CONTRACT_DATE": c("contract_date").isNull() | (c("contract_date") > _date_lit(today)),
    }
    return [Rule(code, t[code], fails[code]) for code, _ in S.CONTRACT_RULE_TEXTS]


def payment_rules() -> list[Rule]:
    t = _texts(S.PAYMENT_RULE_TEXTS)
    c = F.col
    fails = {
        "DUPLICATE_PAYMENT_ID": c("duplicate_rank") > 1,
        "INVALID_PAYMENT_ID": c("payment_id").isNull() | (F.trim(c("payment_id")) == ""),
        "NULL_INSTALLMENT_ID": c("installment_id").isNull(),
        "INSTALLMENT_NOT_FOUND": c("installment_id").isNotNull() & c("matched_installment_id").isNull(),
        "CONTRACT_MISMATCH": (c("expected_contract_id").isNotNull()
                              & (c("contract_id") != c("expected_contract_id"))),
        "INSTALLMENT_NUMBER_MISMATCH": (c("expected_installment_number").isNotNull()
                                        & (c("installment_number") != c("expected_installment_number"))),
        "INVALID_PAYMENT_AMOUNT": c("amount_paid").isNull() | (c("amount_paid") <= 0),
        "INVALID_PAYMENT_DATE": c("payment_date").isNull(),
        "INVALID_EVENT_TIMESTAMP": c("event_timestamp").isNull(),
        "INVALID_EVENT_TYPE": c("event_type") != F.lit(S.PAYMENT_EVENT_TYPE),
        "RESCUED_SOURCE_DATA": c("_rescued_data").isNotNull(),
    }
    return [Rule(code, t[code], fails[code]) for code, _ in S.PAYMENT_RULE_TEXTS]


# ---------------------------------------------------------------------------
# Contracts
# ---------------------------------------------------------------------------

CONTRACT_RANK_ORDER = ["source_updated_at", "source_file_modification_time", "source_file_path"]
PAYMENT_RANK_ORDER = ["event_timestamp", "source_file_modification_time", "source_file_path"]


def classify_contracts(contracts_raw: DataFrame, customers: DataFrame, products: DataFrame,
                       today=None, rank_strategy: str = "auto") -> DataFrame:
    """Rank all raw rows, look up customer and product, apply the contract rules.

    ``customers`` / ``products`` are the trusted (silver) dimensions.
    """
    ranked = rank_duplicates(contracts_raw, ["contract_id"], CONTRACT_RANK_ORDER,
                             tie_cols=S.CONTRACT_TIE_HASH, strategy=rank_strategy)
    cust = customers.select(F.col("customer_id").alias("matched_customer_id"), "customer_type",
                            F.col("snapshot_date").alias("customer_snapshot_date"))
    prod = products.select(F.col("product_id").alias("matched_product_id"),
                           "allowed_customer_type", "max_term_months")
    enriched = lookup_join(ranked, cust, F.col("customer_id") == F.col("matched_customer_id"))
    enriched = lookup_join(enriched, prod, F.col("product_id") == F.col("matched_product_id"))
    return classify(enriched, contract_rules(today))


def split_valid(classified: DataFrame, cols, hash_cols, processed_col: str | None = None,
                codes: str = "error_codes") -> DataFrame:
    """Rows without errors, projected to ``cols`` + ``record_hash`` over ``hash_cols``."""
    out = classified.where(F.size(codes) == 0).select(*cols, record_hash(*hash_cols).alias("record_hash"))
    return out.withColumn(processed_col, F.current_timestamp()) if processed_col else out


def split_quarantine(classified: DataFrame, key: str, cols, hash_cols, processed_col: str | None = None,
                     codes: str = "error_codes") -> DataFrame:
    """Rows with at least one error, with a surrogate ``quarantine_id`` of
    (key, source path, duplicate rank) and a ``record_hash`` over ``hash_cols``."""
    out = (classified.where(F.size(codes) > 0)
           .select(quarantine_key(key, "source_file_path", "duplicate_rank").alias("quarantine_id"),
                   *cols, record_hash(*hash_cols).alias("record_hash")))
    return out.withColumn(processed_col, F.current_timestamp()) if processed_col else out


def contracts_valid(classified: DataFrame, processed_at: bool = False) -> DataFrame:
    return split_valid(classified, S.CONTRACT_VALID_COLUMNS, S.CONTRACT_VALID_HASH,
                       "silver_processed_at" if processed_at else None)


def contracts_quarantine(classified: DataFrame, processed_at: bool = False) -> DataFrame:
    return split_quarantine(classified, "contract_id", S.CONTRACT_QUARANTINE_COLUMNS,
                            S.CONTRACT_QUARANTINE_HASH, "quarantined_at" if processed_at else None)


# ---------------------------------------------------------------------------
# Payments
# ---------------------------------------------------------------------------

def latest_snapshot_slice(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows of the most recent snapshot (``col = (SELECT MAX(col))``).

    Written as a scalar subquery so that, on a table partitioned by ``column``,
    Spark prunes the other partitions at run time.
    """
    mx = df.agg(F.max(column).alias("_mx"))
    return df.where(F.col(column) == mx.select("_mx").scalar())


def classify_payments(payments_raw: DataFrame, installments_raw: DataFrame,
                      rank_strategy: str = "auto") -> DataFrame:
    """Rank payment events, look them up in the latest installment snapshot, apply rules.

    The lookup side holds one current row per installment of the latest
    snapshot, so the left join never multiplies payments.
    """
    if "_rescued_data" not in payments_raw.columns:
        payments_raw = payments_raw.withColumn("_rescued_data", F.lit(None).cast("string"))
    ranked = rank_duplicates(payments_raw, ["payment_id"], PAYMENT_RANK_ORDER,
                             tie_cols=S.PAYMENT_TIE_HASH, strategy=rank_strategy)
    current = latest_snapshot_slice(
        installments_raw.select("installment_id", "contract_id", "installment_number",
                                "snapshot_date", "ingested_at"))
    current = latest_per_key(current, ["installment_id"], ["ingested_at"])
    lookup = current.select(F.col("installment_id").alias("matched_installment_id"),
                            F.col("contract_id").alias("expected_contract_id"),
                            F.col("installment_number").alias("expected_installment_number"))
    enriched = lookup_join(ranked, lookup, F.col("installment_id") == F.col("matched_installment_id"))
    return classify(enriched, payment_rules())


def payments_valid(classified: DataFrame, processed_at: bool = False) -> DataFrame:
    return split_valid(classified, S.PAYMENT_VALID_COLUMNS, S.PAYMENT_VALID_HASH,
                       "silver_processed_at" if processed_at else None)


def payments_quarantine(classified: DataFrame, processed_at: bool = False) -> DataFrame:
    return split_quarantine(classified, "payment_id", S.PAYMENT_QUARANTINE_COLUMNS,
                            S.PAYMENT_QUARANTINE_HASH, "quarantined_at" if processed_at else None)


def error_frequencies(classified: DataFrame, codes: str = "error_codes") -> DataFrame:
    """Occurrences of each error code (``explode`` + ``groupBy``; pre-aggregated map-side)."""
    return (classified.select(F.explode(codes).alias("error_code"))
                      .groupBy("error_code").agg(F.count(F.lit(1)).alias("occurrences")))


def error_combinations(classified: DataFrame, codes: str = "error_codes") -> DataFrame:
    """Rows per distinct code combination (in rule order)."""
    return (classified.where(F.size(codes) > 0)
                      .groupBy(F.array_join(codes, ",").alias("error_codes"))
                      .agg(F.count(F.lit(1)).alias("rows")))
