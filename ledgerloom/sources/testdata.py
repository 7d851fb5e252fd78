"""Credit entities derived from the driver's TPC-H-style tables.

The registered queries read ``customer``, ``nation``, ``orders`` and
``lineitem`` and derive the credit book from them with plain column
expressions, so their work grows with the tables. The same derivation is
written as SQL in :mod:`ledgerloom.plans.oracle`.

FIXED VALUES of the mapping (shared with the SQL oracle):

* as-of date = today = 2000-01-01
* customer type PJ for market segments BUILDING and MACHINERY, else PF;
  state = nation name; rating = A, B, C, D, E by ``c_custkey % 5``;
  monthly income = ``c_acctbal``
* product id = first digit of ``o_orderpriority``; name = text after the dash;
  allowed type PF for 1-3, PJ for 4, PF/PJ for 5; base rate 0.32 - 0.04 * id;
  max term 30 + 6 * id months
* contract term by ``o_orderkey % 6`` -> 6, 12, 18, 24, 36, 48; status
  O -> ACTIVE, F -> CLOSED, P -> PENDING; updated 2000-01-01 07:00; rows with
  ``o_orderkey % 100 = 7`` are delivered twice, the copy updated one day earlier
* installment id = order key, dash, line number padded to 3 digits
* payments: every lineitem; payment id = order key,
  dash, line number; installment id prefixed X when ``l_partkey % 50 = 0``;
  date = ship date + quantity days; amount NULL when quantity = 50, 60 % of the
  price when quantity >= 40, else the price; type REFUND when tax >= 0.08 or the line
  was returned (``l_returnflag = 'R'``);
  event time 10:00 on the payment date; event date = first day of its month
"""

from __future__ import annotations

import datetime as _dt
import posixpath
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.columns import risk_premium

AS_OF = _dt.date(2000, 1, 1)
TODAY = AS_OF
BATCH_ID = "batch_2000-01-01"
CONTRACT_UPDATED_AT = _dt.datetime(2000, 1, 1, 7, 0, 0)
CUSTOMER_UPDATED_AT = _dt.datetime(2000, 1, 1, 6, 0, 0)
SOURCE_MTIME = _dt.datetime(2000, 1, 1, 5, 0, 0)
INGESTED_AT = _dt.datetime(2000, 1, 1, 8, 0, 0)
PJ_SEGMENTS = ("BUILDING", "MACHINERY")
TERM_OPTIONS = (6, 12, 18, 24, 36, 48)
DUPLICATE_EVERY, DUPLICATE_REMAINDER = 100, 7
ORPHAN_PARTKEY_MOD = 50
NULL_AMOUNT_QTY, PARTIAL_QTY, PARTIAL_SHARE = 50, 40, Decimal("0.60")
REFUND_TAX = 0.08


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def rating_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in S.RISK_RATINGS]),
                        (F.pmod(key, F.lit(len(S.RISK_RATINGS))) + 1).cast("int"))


def installment_key(order_key: Column, line: Column) -> Column:
    return F.concat_ws("-", order_key.cast("string"), F.lpad(line.cast("string"), 3, "0"))


def _meta(path: str) -> list[Column]:
    return [F.lit(path).alias("source_file_path"),
            F.lit(posixpath.basename(path)).alias("source_file_name"),
            F.lit(SOURCE_MTIME).cast("timestamp").alias("source_file_modification_time"),
            F.lit(INGESTED_AT).cast("timestamp").alias("ingested_at")]


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_acctbal", "c_mktsegment")
    # a plain scan of the nation file: Spark's planner broadcasts it by its file-size statistics
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    key = F.col("c_custkey")
    return j.select(
        key.cast("long").alias("customer_id"),
        F.when(F.col("c_mktsegment").isin(*PJ_SEGMENTS), F.lit("PJ")).otherwise(F.lit("PF"))
         .alias("customer_type"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("DOC"), F.lpad(key.cast("string"), 11, "0")).alias("document_id"),
        F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.invalid")).alias("email"),
        F.col("n_name").alias("state"),
        rating_of(key).alias("risk_rating"),
        F.col("c_acctbal").cast(S.MONEY).alias("monthly_income"),
        F.lit(_dt.date(1995, 1, 1)).alias("created_at"),
        F.lit(CUSTOMER_UPDATED_AT).cast("timestamp").alias("updated_at"),
        F.lit(True).alias("is_active"),
        F.lit("TPCH_CUSTOMER").alias("source_system"),
        F.lit(BATCH_ID).alias("source_batch_id"),
        F.lit(AS_OF).alias("snapshot_date"),
        *_meta("customer.parquet")[:3],
        F.lit(None).cast("string").alias("corrupt_record"),
        _meta("customer.parquet")[3],
    )


def product_id_of(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int")


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    pid = product_id_of(F.col("o_orderpriority"))
    return p.select(
        pid.alias("product_id"),
        F.substring_index(F.col("o_orderpriority"), "-", -1).alias("product_name"),
        F.when(pid <= 3, F.lit("PF")).when(pid == 4, F.lit("PJ")).otherwise(F.lit("PF/PJ"))
         .alias("allowed_customer_type"),
        (F.lit(Decimal("0.32")) - F.lit(Decimal("0.04")) * pid).cast(S.RATE)
         .alias("base_annual_interest_rate"),
        (F.lit(30) + F.lit(6) * pid).cast("int").alias("max_term_months"),
        F.lit(BATCH_ID).alias("source_batch_id"),
        *_meta("orders.parquet"),
    )


def contracts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base contracts plus the second delivery, in one pass over ``orders``:
    each order yields one row, or two when it is re-delivered."""
    base = contracts_base(spark, sf_dir)
    again = F.pmod(F.col("contract_id"), F.lit(DUPLICATE_EVERY)) == DUPLICATE_REMAINDER
    copy_no = F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = base.select("*", copy_no.alias("_copy"))
    out = out.withColumn("source_updated_at",
                         F.when(F.col("_copy") == 1, F.col("source_updated_at") - F.expr("INTERVAL 1 DAY"))
                          .otherwise(F.col("source_updated_at")))
    return out.drop("_copy")


def contract_copies(base: DataFrame) -> DataFrame:
    """The second delivery of some contracts, updated one day earlier."""
    return (base.where(F.pmod(F.col("contract_id"), F.lit(DUPLICATE_EVERY)) == DUPLICATE_REMAINDER)
                .withColumn("source_updated_at", F.col("source_updated_at") - F.expr("INTERVAL 1 DAY")))


def contracts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    pid = product_id_of(F.col("o_orderpriority"))
    base_rate = F.lit(Decimal("0.32")) - F.lit(Decimal("0.04")) * pid
    terms = F.array(*[F.lit(t) for t in TERM_OPTIONS])
    base = o.select(
        F.col("o_orderkey").cast("long").alias("contract_id"),
        F.col("o_custkey").cast("long").alias("customer_id"),
        pid.alias("product_id"),
        F.col("o_orderdate").cast("date").alias("contract_date"),
        F.col("o_totalprice").cast(S.MONEY).alias("principal_amount"),
        (base_rate + risk_premium(rating_of(F.col("o_custkey")))).cast(S.RATE)
         .alias("annual_interest_rate"),
        F.element_at(terms, (F.pmod(F.col("o_orderkey"), F.lit(len(TERM_OPTIONS))) + 1).cast("int"))
         .alias("term_months"),
        F.when(F.col("o_orderstatus") == "O", F.lit("ACTIVE"))
         .when(F.col("o_orderstatus") == "F", F.lit("CLOSED"))
         .when(F.col("o_orderstatus") == "P", F.lit("PENDING")).alias("contract_status"),
        F.lit(CONTRACT_UPDATED_AT).cast("timestamp").alias("source_updated_at"),
        F.lit("TPCH_ORDERS").alias("source_system"),
        F.lit(BATCH_ID).alias("source_batch_id"),
        *_meta("orders.parquet"),
    )
    return base


def installments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem. (order, line) is not unique: the extra ``src_*``
    columns carry the source's own tie-break for the latest-row selection."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        installment_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("installment_id"),
        F.col("l_orderkey").cast("long").alias("contract_id"),
        F.col("l_linenumber").cast("int").alias("installment_number"),
        F.col("l_shipdate").cast("date").alias("due_date"),
        F.col("l_extendedprice").cast(S.MONEY).alias("scheduled_amount"),
        F.lit("TPCH_LINEITEM").alias("source_system"),
        F.lit(BATCH_ID).alias("source_batch_id"),
        F.lit(AS_OF).alias("snapshot_date"),
        *_meta("lineitem.parquet"),
        F.col("l_partkey").alias("src_partkey"),
        F.col("l_suppkey").alias("src_suppkey"),
        F.col("l_quantity").alias("src_quantity"),
        F.col("l_discount").alias("src_discount"),
        F.col("l_tax").alias("src_tax"),
    )


INSTALLMENT_ORDER = ["snapshot_date", "ingested_at", "due_date", "src_partkey", "src_suppkey",
                     "scheduled_amount", "src_quantity", "src_discount", "src_tax"]


def payments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity")
    price = F.col("l_extendedprice").cast(S.MONEY)
    pay_date = F.date_add(F.col("l_shipdate").cast("date"), qty.cast("int"))
    inst = installment_key(F.col("l_orderkey"), F.col("l_linenumber"))
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
         .alias("payment_id"),
        F.when(F.pmod(F.col("l_partkey"), F.lit(ORPHAN_PARTKEY_MOD)) == 0, F.concat(F.lit("X"), inst))
         .otherwise(inst).alias("installment_id"),
        F.col("l_orderkey").cast("long").alias("contract_id"),
        F.col("l_linenumber").cast("int").alias("installment_number"),
        pay_date.alias("payment_date"),
        F.when(qty == NULL_AMOUNT_QTY, F.lit(None).cast(S.MONEY))
         .when(qty >= PARTIAL_QTY, (price * F.lit(PARTIAL_SHARE)).cast(S.MONEY))
         .otherwise(price).alias("amount_paid"),
        F.when((F.col("l_tax") >= REFUND_TAX) | (F.col("l_returnflag") == "R"), F.lit("REFUND")).otherwise(F.lit("PAYMENT"))
         .alias("event_type"),
        (pay_date.cast("timestamp") + F.expr("INTERVAL 10 HOURS")).alias("event_timestamp"),
        F.lit("TPCH_LINEITEM").alias("source_system"),
        F.lit(BATCH_ID).alias("source_batch_id"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.trunc(pay_date, "MM").alias("event_date"),
        *_meta("lineitem.parquet"),
    )


def latest_installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerloom.operators.reconcile import latest_installments as _latest
    return _latest(installments_raw(spark, sf_dir), INSTALLMENT_ORDER)


PREVIOUS_SNAPSHOT = _dt.date(1999, 12, 1)


def installment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots: the installments due before 1999-12-01 as known on that
    date, and the full current snapshot."""
    cur = installments_raw(spark, sf_dir)
    known_then = F.col("due_date") < F.lit(PREVIOUS_SNAPSHOT)
    snaps = F.explode(F.when(known_then, F.array(F.lit(AS_OF), F.lit(PREVIOUS_SNAPSHOT)))
                       .otherwise(F.array(F.lit(AS_OF))))
    return cur.drop("snapshot_date").select("*", snaps.alias("snapshot_date")).select(*cur.columns)
