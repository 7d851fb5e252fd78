"""Contract terms: schedule expansion, risk pricing, hash assignment, defects.

``expand_schedule`` is a generator (``explode(sequence(1, term))``): it is
narrow, so each contract's schedule is produced in the task that holds the
contract and no shuffle is added. The instalment amount is computed exactly
in integer cents (HALF_UP), so it does not depend on floating point.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.columns import as_col, risk_premium


def expand_schedule(contracts: DataFrame) -> DataFrame:
    """One row per instalment 1..term: id ``<contract>-NNN``, due = contract date + n months.

    Amount = round(P * (1 + r * n / 12) / n, 2) HALF_UP, computed exactly: with
    P in cents and r in 1/10000, cents = P_c * (120000 + r_u * n) / (120000 * n),
    evaluated in DECIMAL(38,0) with integral division.
    """
    n = F.col("installment_number")
    exploded = (contracts.where(F.col("term_months") > 0)
                .select("contract_id", "contract_date", "principal_amount", "annual_interest_rate",
                        "term_months",
                        F.explode(F.sequence(F.lit(1), F.col("term_months"))).alias("installment_number")))
    p_c = (F.col("principal_amount") * F.lit(100)).cast("decimal(38,0)")
    r_u = (F.col("annual_interest_rate") * F.lit(10000)).cast("decimal(38,0)")
    term = F.col("term_months").cast("decimal(38,0)")
    staged = exploded.withColumns({
        "_num": (p_c * (F.lit(120000).cast("decimal(38,0)") + r_u * term)).cast("decimal(38,0)"),
        "_den": (F.lit(120000).cast("decimal(38,0)") * term).cast("decimal(38,0)"),
    })
    cents = F.expr("CASE WHEN _num < 0 THEN -((2 * abs(_num) + _den) div (2 * _den))"
                   " ELSE (2 * _num + _den) div (2 * _den) END")
    return staged.select(
        F.concat_ws("-", F.col("contract_id").cast("string"), F.lpad(n.cast("string"), 3, "0"))
         .alias("installment_id"),
        "contract_id", n.cast("int").alias("installment_number"),
        F.add_months(F.col("contract_date"), n).alias("due_date"),
        (cents.cast("decimal(20,0)") / F.lit(100)).cast(S.MONEY).alias("scheduled_amount"))


def price_contracts(contracts: DataFrame, customers: DataFrame, products: DataFrame,
                    premiums: dict | None = None) -> DataFrame:
    """Risk-priced rate (base + premium by rating, 4 decimals) and term capped by the product."""
    cust = customers.select("customer_id", "risk_rating")
    prod = products.select("product_id", "base_annual_interest_rate", "max_term_months")
    j = contracts.join(cust, "customer_id", "inner").join(prod, "product_id", "inner")
    prem = risk_premium(F.col("risk_rating"), premiums)
    return j.select("contract_id", "customer_id", "product_id", "risk_rating", "base_annual_interest_rate",
                    prem.cast("decimal(10,4)").alias("risk_premium"),
                    F.round(F.col("base_annual_interest_rate") + prem, 4).cast(S.RATE).alias("priced_rate"),
                    F.col("term_months").alias("requested_term_months"),
                    F.least(F.col("term_months"), F.col("max_term_months")).alias("term_months"))


@dataclass(frozen=True)
class Defect:
    """Rows matching ``where``, re-emitted with ``overrides`` (column -> Column or value)."""
    name: str
    where: Column
    overrides: dict = field(default_factory=dict)


def inject_defects(df: DataFrame, defects: Sequence[Defect]) -> DataFrame:
    """``df`` plus one copy of the matching rows per defect (bag union by name)."""
    out = df
    for d in defects:
        extra = df.where(d.where)
        over = {c: (v if isinstance(v, Column) else F.lit(v)).cast(df.schema[c].dataType)
                for c, v in d.overrides.items()}
        if over:
            extra = extra.withColumns(over)
        out = out.unionByName(extra)
    return out


# Fixed values of the known-defect scenario: the contracts copied, and the ids and amount the copies get.
DEFECT_SOURCES = (10, 11, 12)
DEFECT_IDS = (9_000_001, 9_000_002)
DEFECT_CUSTOMER = 9_999_999
DEFECT_PRINCIPAL = -500


def standard_defects(key: str = "contract_id") -> list[Defect]:
    """The known-defect scenario: a duplicate, a negative principal, an orphan customer."""
    duplicate, negative, orphan = (F.col(key) == i for i in DEFECT_SOURCES)
    return [
        Defect("duplicate", duplicate),
        Defect("negative_principal", negative, {key: DEFECT_IDS[0], "principal_amount": DEFECT_PRINCIPAL}),
        Defect("orphan_customer", orphan, {key: DEFECT_IDS[1], "customer_id": DEFECT_CUSTOMER}),
    ]


def payment_defects(first_payment_id: str, key: str = "payment_id") -> list[Defect]:
    """The payment side of the known-defect scenario: the first event delivered
    twice, and a copy of it under a new id with no amount."""
    first = F.col(key) == F.lit(first_payment_id)
    return [Defect("duplicate_event", first),
            Defect("null_amount", first, {key: "INVALID_NULL_AMOUNT", "amount_paid": None})]
