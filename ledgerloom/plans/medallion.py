"""The data product end to end on tables: landing files -> bronze -> silver -> gold -> checks.

Steps run in the dependency order of the product's job (setup, sources,
{batch bronze, snapshot bronze, payment bronze}, dimensions, contracts,
payments, installments, gold, quality). Each step reads only tables written by
earlier steps, so any step can be re-run on its own after a failure:

* bronze loads are exactly-once streams (a re-run adds nothing),
* snapshot loads put one partition in place,
* silver tables are synchronised by the hash-gated merge (re-run = all KEEP),
* gold tables are rebuilt whole.
"""

from __future__ import annotations

import datetime as _dt
import posixpath
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas as S
from ledgerloom.operators import checks as C
from ledgerloom.operators import portfolio as P
from ledgerloom.operators import pricing as PR
from ledgerloom.operators import quality as Q
from ledgerloom.operators import reconcile as R
from ledgerloom.operators.dedupe import duplicate_keys
from ledgerloom.sinks import keyed as K
from ledgerloom.sinks import tables as TB
from ledgerloom.sources import files as FS
from ledgerloom.sources import testdata as TD
from ledgerloom.streaming import tables as ST

LAYERS = {
    "bronze": "Raw data as received, with source metadata.",
    "silver": "Typed, deduplicated and validated data with quarantine.",
    "gold": "Analytical model of the credit portfolio.",
    "ops": "Operational quality history.",
}


@dataclass
class Lake:
    """Where the product lives: a shared root (landing, tables, checkpoints) and a schema prefix."""
    root: str
    prefix: str = "ll"
    today: _dt.date | None = None       # contract-date rule; None = current_date()
    expectations: dict = field(default_factory=dict)
    bucket_rows: int = K.BUCKET_ROWS    # rows in a bucket of a silver table, about

    def t(self, layer: str, name: str) -> str:
        return f"{self.prefix}_{layer}.{name}"

    def path(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)


# ---------------------------------------------------------------------------
# declared tables
# ---------------------------------------------------------------------------

META = T.StructType(S.SOURCE_META_FIELDS)
PRODUCTS_RAW = T.StructType(S.PRODUCT_SOURCE.fields + META.fields)
CONTRACTS_RAW = T.StructType(S.CONTRACT_SOURCE.fields + META.fields)
CUSTOMERS_RAW = T.StructType(S.CUSTOMER_SOURCE.fields + [
    T.StructField("snapshot_date", T.DateType()), *META.fields[:3],
    T.StructField("corrupt_record", T.StringType()), META.fields[3]])
INSTALLMENTS_RAW = T.StructType(S.INSTALLMENT_SOURCE.fields + [
    T.StructField("source_file_path", T.StringType()), T.StructField("source_file_name", T.StringType()),
    T.StructField("source_file_size", T.LongType()),
    T.StructField("source_file_modification_time", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()), T.StructField("snapshot_date", T.DateType())])
PAYMENTS_RAW = T.StructType(S.PAYMENT_SOURCE.fields + [
    T.StructField("_rescued_data", T.StringType()),
    T.StructField("source_file_path", T.StringType()), T.StructField("source_file_name", T.StringType()),
    T.StructField("source_file_size", T.LongType()),
    T.StructField("source_file_modification_time", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()), T.StructField("event_date", T.DateType())])


def setup(spark: SparkSession, lake: Lake) -> None:
    TB.ensure_namespaces(spark, {f"{lake.prefix}_{k}": v for k, v in LAYERS.items()},
                         location=lake.path("warehouse"))
    props = {"data_layer": "bronze", "contains_synthetic_data": "true"}
    TB.ensure_table(spark, lake.t("bronze", "customers_raw"), CUSTOMERS_RAW, "Customer snapshots (JSON).",
                    {**props, "ingestion_pattern": "snapshot_replace"}, partition_by=["snapshot_date"],
                    location=lake.path("tables", "bronze", "customers_raw"))
    TB.ensure_table(spark, lake.t("bronze", "installments_raw"), INSTALLMENTS_RAW,
                    "Installment snapshots (Parquet).", {**props, "ingestion_pattern": "snapshot_replace"},
                    partition_by=["snapshot_date"], location=lake.path("tables", "bronze", "installments_raw"))
    for name, schema, parts in (("products_raw", PRODUCTS_RAW, []), ("contracts_raw", CONTRACTS_RAW, []),
                                ("payments_raw", PAYMENTS_RAW, ["event_date"])):
        ST.declare_sink(spark, lake.t("bronze", name), schema, partition_by=parts, comment=f"{name} (stream sink)",
                        props={**props, "ingestion_pattern": "incremental"}, location=lake.path("tables", "bronze", name))
    ST.declare_sink(spark, lake.t("ops", "load_log"), ST.LOAD_LOG,
                    comment="One labelled row per bronze load or batch of one (stands in for commit annotations).",
                    props={"data_domain": "operations"}, location=lake.path("tables", "ops", "load_log"))
    TB.ensure_table(spark, lake.t("ops", "data_quality_results"), S.QUALITY_RESULTS,
                    "Append-only history of quality checks.", {"data_domain": "operations"},
                    location=lake.path("tables", "ops", "data_quality_results"))


# ---------------------------------------------------------------------------
# landing (the source systems' deliveries, derived from the fixture tables)
# ---------------------------------------------------------------------------

def write_landing_from_testdata(spark: SparkSession, sf_dir: str, lake: Lake,
                                snapshot: _dt.date = TD.AS_OF, defects: bool = False) -> None:
    """The source deliveries derived from the fixture tables; ``defects`` adds the
    known-defect scenario (3 bad contracts, 2 bad payment events)."""
    land = lake.path("landing")
    prod_cols = [f.name for f in S.PRODUCT_SOURCE.fields]
    FS.write_landing(TD.products_raw(spark, sf_dir).select(*prod_cols),
                     posixpath.join(land, "products", "full"), "csv")
    cust_cols = [f.name for f in S.CUSTOMER_SOURCE.fields]
    FS.write_landing(TD.customers_raw(spark, sf_dir).select(*cust_cols),
                     posixpath.join(land, "customers", f"snapshot_date={snapshot}"), "json")
    con_cols = [f.name for f in S.CONTRACT_SOURCE.fields]
    contracts = TD.contracts_raw(spark, sf_dir).select(*con_cols)
    if defects:
        contracts = PR.inject_defects(contracts, PR.standard_defects())
    FS.write_landing(contracts, posixpath.join(land, "contracts", f"batch_date={snapshot}"), "csv")
    inst = TD.latest_installments(spark, sf_dir).select(
        *[F.col(f.name) for f in S.INSTALLMENT_SOURCE.fields if f.name != "scheduled_amount"],
        F.col("scheduled_amount").cast("double").alias("scheduled_amount"))
    FS.write_landing(inst, posixpath.join(land, "installments", f"snapshot_date={snapshot}"), "parquet")
    pay_cols = [f.name for f in S.PAYMENT_SOURCE.fields]
    payments = TD.payments_raw(spark, sf_dir).select(*pay_cols, "event_date")
    if defects:
        first = payments.agg(F.min("payment_id")).first()[0]   # one scalar
        payments = PR.inject_defects(payments, PR.payment_defects(first))
    FS.write_landing(payments, posixpath.join(land, "payments"), "json", partition_by=["event_date"])


# ---------------------------------------------------------------------------
# bronze
# ---------------------------------------------------------------------------

def load_bronze_batch(spark: SparkSession, lake: Lake) -> dict:
    """Products and contracts CSV: every file loaded exactly once, each by its own header."""
    out = {}
    for name, schema, table_schema, sub in (
            ("products_raw", S.PRODUCT_SOURCE, PRODUCTS_RAW, "products/full"),
            ("contracts_raw", S.CONTRACT_SOURCE, CONTRACTS_RAW, "contracts")):
        out[name] = ST.load_files(
            spark, name, lake.path("landing", sub), "csv", schema, lake.t("bronze", name),
            lake.path("checkpoints", "bronze", name), log=lake.t("ops", "load_log"),
            transform=lambda df, c=table_schema.fieldNames(): df.select(*c))["rows"]
    return out


def load_bronze_snapshots(spark: SparkSession, lake: Lake, snapshot: _dt.date) -> dict:
    """Customers (permissive JSON) and installments (typed Parquet) of one snapshot date,
    gated before publishing, then replacing exactly that snapshot."""
    cust_path = lake.path("landing", "customers", f"snapshot_date={snapshot}")
    cust = (FS.read_permissive_json(spark, cust_path, S.CUSTOMER_SOURCE)
            .withColumn("snapshot_date", F.lit(snapshot)))

    def whole(rows: DataFrame, label: str, key: str, bad: F.Column) -> None:
        m = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("ids"),
                     F.count(F.when(bad, 1)).alias("bad")).first()
        if m["rows"] == 0 or m["rows"] != m["ids"] or m["bad"]:
            raise AssertionError(f"{label} snapshot gate: {m.asDict()}")

    # the gates read the written slice, so that each source is evaluated once
    n_cust = TB.replace_snapshot(cust, lake.t("bronze", "customers_raw"), "snapshot_date", snapshot,
                                 lambda rows: whole(rows, "customer", "customer_id", F.col("corrupt_record").isNotNull()))
    inst_path = lake.path("landing", "installments", f"snapshot_date={snapshot}")
    inst = (FS.read_typed_parquet(spark, inst_path, S.INSTALLMENT_SOURCE, size=True)
            .withColumn("snapshot_date", F.lit(snapshot)))
    n_inst = TB.replace_snapshot(inst, lake.t("bronze", "installments_raw"), "snapshot_date", snapshot,
                                 lambda rows: whole(rows, "installment", "installment_id", F.col("scheduled_amount") <= 0))
    for name, rows in (("customers", n_cust), ("installments", n_inst)):
        label = f"{name} snapshot_date={snapshot}"
        ST.log_load(spark, lake.t("ops", "load_log"), f"{name}_raw", label, rows, f"{label} {uuid.uuid4().hex[:8]}")
    return {"customers": n_cust, "installments": n_inst}


def load_bronze_payments(spark: SparkSession, lake: Lake) -> int:
    """Payment events: JSON stream with rescue, partition column from the directory."""
    part = T.StructType([T.StructField("event_date", T.DateType())])
    cols = PAYMENTS_RAW.fieldNames()
    return ST.load_files(spark, "payments_raw", lake.path("landing", "payments"), "json", S.PAYMENT_SOURCE,
                         lake.t("bronze", "payments_raw"), lake.path("checkpoints", "bronze", "payments_raw"),
                         partition_cols=part, rescue=True, transform=lambda df: df.select(*cols),
                         log=lake.t("ops", "load_log"), query_name=f"{lake.prefix}_payments_bronze")["rows"]


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------

def build_silver_dimensions(spark: SparkSession, lake: Lake) -> None:
    TB.replace_table(P.silver_customers(spark.table(lake.t("bronze", "customers_raw")))
                     .withColumn("silver_processed_at", F.current_timestamp()), lake.t("silver", "customers"))
    TB.replace_table(P.silver_products(spark.table(lake.t("bronze", "products_raw")))
                     .withColumn("silver_processed_at", F.current_timestamp()), lake.t("silver", "products"))


def _kept_facts(name: str) -> dict:
    """Facts of a silver table that the merge keeps, for the gates and checks."""
    return {"installments": lambda: {"negative_balances": F.count(F.when(F.col("outstanding_amount") < 0, 1)),
                                     "scheduled_amount": F.sum("scheduled_amount")}}.get(name, dict)()


def _sync(spark: SparkSession, lake: Lake, name: str, source: DataFrame, key: str) -> dict:
    """Hash-gated merge into a silver table, bucket by bucket: a run reads and
    rewrites only the buckets where something changed."""
    table = lake.t("silver", name)
    K.declare_keyed(spark, table, source.schema, comment=f"silver {name}", props={"data_layer": "silver"},
                    location=lake.path("tables", "silver", name))
    return K.sync(spark, table, source, key, bucket_rows=lake.bucket_rows, kept=_kept_facts(name))


def _stage(spark: SparkSession, lake: Lake, df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate once (it is read by two consumers) and read it back;
    this also cuts the lineage, so a lost executor does not recompute the inputs."""
    path = lake.path("staging", f"{label}-{uuid.uuid4().hex[:8]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def build_silver_contracts(spark: SparkSession, lake: Lake) -> dict:
    classified = _stage(spark, lake, Q.classify_contracts(
        spark.table(lake.t("bronze", "contracts_raw")), spark.table(lake.t("silver", "customers")),
        spark.table(lake.t("silver", "products")), today=lake.today), "contracts_classified")
    return {"valid": _sync(spark, lake, "contracts", Q.contracts_valid(classified, processed_at=True),
                           "contract_id"),
            "quarantine": _sync(spark, lake, "contracts_quarantine",
                                Q.contracts_quarantine(classified, processed_at=True), "quarantine_id")}


def build_silver_payments(spark: SparkSession, lake: Lake) -> dict:
    classified = _stage(spark, lake, Q.classify_payments(
        spark.table(lake.t("bronze", "payments_raw")),
        TB.newest_slice(spark, lake.t("bronze", "installments_raw"), "snapshot_date")),
        "payments_classified")
    return {"valid": _sync(spark, lake, "payments", Q.payments_valid(classified, processed_at=True),
                           "payment_id"),
            "quarantine": _sync(spark, lake, "payments_quarantine",
                                Q.payments_quarantine(classified, processed_at=True), "quarantine_id")}


def build_silver_installments(spark: SparkSession, lake: Lake) -> dict:
    raw = spark.table(lake.t("bronze", "installments_raw"))
    as_of = TB.newest_partition(spark, lake.t("bronze", "installments_raw"), "snapshot_date")
    rec = R.reconcile_installments(R.latest_installments(raw).drop("snapshot_date"),
                                   spark.table(lake.t("silver", "contracts")),
                                   spark.table(lake.t("silver", "payments")), as_of, processed_at=True)
    return _sync(spark, lake, "installments", rec, "installment_id")


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------

def build_gold(spark: SparkSession, lake: Lake) -> None:
    customers = spark.table(lake.t("silver", "customers"))
    products = spark.table(lake.t("silver", "products"))
    TB.replace_table(P.dim_customer(customers), lake.t("gold", "dim_customer"))
    TB.replace_table(P.dim_product(products), lake.t("gold", "dim_product"))
    inst = spark.table(lake.t("silver", "installments"))
    fact = P.portfolio_fact(spark.table(lake.t("silver", "contracts")), inst, processed_at=True)
    TB.replace_table(fact, lake.t("gold", "fact_credit_portfolio"))
    kpis = P.portfolio_kpis(spark.table(lake.t("gold", "fact_credit_portfolio")),
                            spark.table(lake.t("gold", "dim_customer")),
                            spark.table(lake.t("gold", "dim_product")), processed_at=True)
    TB.replace_table(kpis, lake.t("gold", "portfolio_kpis"))
    P.create_executive_view(spark, lake.t("gold", "vw_executive_portfolio"), lake.t("gold", "fact_credit_portfolio"))


# ---------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------

def run_quality(spark: SparkSession, lake: Lake, run_id: str | None = None,
                run_ts: _dt.datetime | None = None, gate: bool = True) -> DataFrame:
    t = lambda layer, name: spark.table(lake.t(layer, name))
    e = lake.expectations
    fact = t("gold", "fact_credit_portfolio")
    silver = K.facts(spark, lake.t("silver", "installments"), "negative_balances", "scheduled_amount")
    metrics = {
        "products_raw": C.profile(t("bronze", "products_raw")),
        "customers_raw": C.profile(t("bronze", "customers_raw"), key="customer_id"),
        "contracts_raw": C.profile(t("bronze", "contracts_raw")),
        # of silver tables, what the merges kept
        **{n: K.facts(spark, lake.t("silver", n)) for n in ("contracts", "contracts_quarantine", "payments", "payments_quarantine")},
        "installments": silver.select(F.col("negative_balances").cast("bigint").alias("negative_balances")),
        "fact_credit_portfolio": C.profile(fact, key="contract_id", extra={"gold": F.sum("contractual_amount")}).select(
            "duplicate_rows", F.abs(silver.select("scheduled_amount").scalar() - F.coalesce("gold", F.lit(0))).cast("decimal(22,2)")
            .alias("reconciliation_delta")),
        "dim_customer": t("gold", "dim_customer").agg(
            F.lit(C.pii_exposure(t("gold", "dim_customer"))).alias("pii_columns")),
    }
    checks = [
        C.Check("silver", "payments", "no_duplicate_payment_ids", "duplicate_rows", 0),
        C.Check("silver", "installments", "no_negative_outstanding_balance", "negative_balances", 0),
        C.Check("gold", "fact_credit_portfolio", "one_row_per_contract", "duplicate_rows", 0),
        C.Check("gold", "fact_credit_portfolio", "scheduled_amount_reconciliation", "reconciliation_delta",
                "0.00", details="Silver installments versus Gold contract portfolio."),
        C.Check("gold", "dim_customer", "pii_columns_not_exposed", "pii_columns", 0),
    ]
    for (layer, ds, name, metric), key in [
            (("bronze", "products_raw", "expected_row_count", "rows"), "products"),
            (("bronze", "customers_raw", "expected_distinct_customers", "distinct_keys"), "customers"),
            (("bronze", "contracts_raw", "expected_row_count_with_known_errors", "rows"), "contracts_raw"),
            (("silver", "contracts", "expected_valid_contracts", "rows"), "contracts_valid"),
            (("silver", "contracts_quarantine", "expected_known_rejections", "rows"), "contracts_quarantine"),
            (("silver", "payments_quarantine", "expected_known_rejections", "rows"), "payments_quarantine")]:
        if key in e:
            checks.append(C.Check(layer, ds, name, metric, e[key]))
    results = C.run_checks(spark, metrics, checks, run_id or str(uuid.uuid4()),
                           run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    results = _stage(spark, lake, results, "quality")
    if gate:
        C.publish_and_gate(results, lake.t("ops", "data_quality_results"))
    else:
        TB.append_table(results, lake.t("ops", "data_quality_results"))
    return results


class StepGateError(AssertionError):
    pass


def _gate(step: str, row, checks: dict) -> None:
    """Post-condition of a step: each metric must equal its expected value."""
    bad = {k: (row[k], v) for k, v in checks.items() if v is not None and row[k] != v}
    if bad:
        raise StepGateError(f"{step}: {bad}")


def _gate_bronze(spark: SparkSession, lake: Lake) -> None:
    e, raw = lake.expectations, spark.table(lake.t("bronze", "contracts_raw"))
    dup_ids = duplicate_keys(raw, ["contract_id"]).agg(F.count(F.lit(1))).scalar()
    b = raw.agg(F.count(F.lit(1)).alias("contracts"),
                F.count(F.when(F.col("principal_amount") <= 0, 1)).alias("invalid_principal_rows"),
                dup_ids.alias("duplicated_contract_ids"),
                spark.table(lake.t("bronze", "products_raw")).agg(F.count(F.lit(1))).scalar().alias("products")).first()
    _gate("bronze", b, {"products": e.get("products"), "contracts": e.get("contracts_raw"),
                        "duplicated_contract_ids": e.get("contracts_duplicated_ids"),
                        "invalid_principal_rows": e.get("contracts_invalid_principal")})


def _gate_bronze_payments(spark: SparkSession, lake: Lake) -> None:
    e = lake.expectations
    pay = spark.table(lake.t("bronze", "payments_raw")).agg(
        (F.count(F.lit(1)) - F.count_distinct("payment_id")).alias("duplicate_rows"),
        F.count(F.when(F.col("payment_id").isNull(), 1)).alias("null_ids"),
        F.count(F.when(F.col("amount_paid").isNull(), 1)).alias("null_amounts"),
        F.count("_rescued_data").alias("rescued")).first()
    _gate("bronze payments", pay, {"duplicate_rows": e.get("payments_duplicate_rows"),
                                   "null_ids": e.get("payments_null_ids"),
                                   "null_amounts": e.get("payments_null_amounts"),
                                   "rescued": e.get("payments_rescued")})


def _gate_keys(spark: SparkSession, lake: Lake, table: str, rows=None, *zero: str) -> None:
    """A silver table's rows have keys of their own, its rows are as many as expected, and each fact in ``zero`` is 0."""
    r = K.facts(spark, lake.t("silver", table), *zero).first()
    _gate(f"silver {table}", r, {"distinct_keys": r["rows"], "rows": rows, **dict.fromkeys(zero, 0)})


def _gate_contracts(spark: SparkSession, lake: Lake) -> None:
    _gate_keys(spark, lake, "contracts", lake.expectations.get("contracts_valid"))


def _gate_payments(spark: SparkSession, lake: Lake) -> None:
    _gate_keys(spark, lake, "payments")


def _gate_installments(spark: SparkSession, lake: Lake) -> None:
    _gate_keys(spark, lake, "installments", None, "negative_balances")


def _gate_gold(spark: SparkSession, lake: Lake) -> None:
    r = spark.table(lake.t("gold", "fact_credit_portfolio")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("contract_id").alias("ids")).first()
    _gate("gold", r, {"ids": r["rows"]})


GATES = [_gate_bronze, _gate_bronze_payments, _gate_contracts, _gate_payments, _gate_installments, _gate_gold]


def gate_steps(spark: SparkSession, lake: Lake) -> None:
    """All post-publish gates: invariants always, counts when expected; one aggregate each."""
    for gate in GATES:
        gate(spark, lake)


def run_all(spark: SparkSession, lake: Lake, snapshot: _dt.date, gate: bool = True) -> dict:
    """Every step in dependency order, each stopped by its gate before the next; returns the per-step counts."""
    def gated(check, result=None):
        if gate:
            check(spark, lake)
        return result

    setup(spark, lake)
    out = {"bronze_batch": gated(_gate_bronze, load_bronze_batch(spark, lake)),
           "bronze_snapshots": load_bronze_snapshots(spark, lake, snapshot),
           "bronze_payments": gated(_gate_bronze_payments, load_bronze_payments(spark, lake))}
    dups = duplicate_keys(spark.table(lake.t("bronze", "contracts_raw")), ["contract_id"]).count()
    out["bronze_duplicated_contract_ids"] = dups
    build_silver_dimensions(spark, lake)
    out["silver_contracts"] = gated(_gate_contracts, build_silver_contracts(spark, lake))
    out["silver_payments"] = gated(_gate_payments, build_silver_payments(spark, lake))
    out["silver_installments"] = gated(_gate_installments, build_silver_installments(spark, lake))
    gated(_gate_gold, build_gold(spark, lake))
    run_quality(spark, lake, gate=gate)
    return out
