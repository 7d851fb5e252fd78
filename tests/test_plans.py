"""Physical-plan properties the scale design relies on."""
import datetime as dt
import os

import pytest

from ledgerloom.operators import reconcile as R
from ledgerloom.operators.dedupe import latest_per_key, rank_duplicates
from ledgerloom.plans.book import CreditBook
from ledgerloom.sources import testdata as TD

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_as_of_cutoff_and_column_pruning_reach_the_scan(spark, tmp_root):
    path = os.path.join(tmp_root, "pay")
    TD.payments_raw(spark, SF).write.parquet(path)
    totals = R.payment_totals(spark.read.parquet(path), dt.date(2000, 1, 1))
    p = plan(totals)
    assert "PushedFilters: [IsNotNull(payment_date), LessThanOrEqual(payment_date,2000-01-01)]" in p
    scan = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line][0]
    assert "event_type" not in scan and "installment_id" in scan   # only needed columns are read


def test_latest_per_key_is_limited_map_side(spark):
    p = plan(latest_per_key(TD.installments_raw(spark, SF), ["installment_id"], TD.INSTALLMENT_ORDER))
    # a partial WindowGroupLimit runs before the exchange, the final one after it
    assert p.count("WindowGroupLimit") == 2
    assert p.index("Exchange") < p.rindex("WindowGroupLimit")


def test_rank_without_hot_keys_is_one_window(spark):
    df = CreditBook(spark, SF).contracts_raw
    p = plan(rank_duplicates(df, ["contract_id"], ["source_updated_at"]))
    assert p.count("Window") == 1 and "Union" not in p.split("Window")[0]


def test_dimensions_are_left_to_the_planner(spark):
    p = CreditBook(spark, SF).contracts_classified._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("strategy=broadcast") == 0


def test_reconcile_and_position_shuffle_installments_once_by_contract(spark):
    """Large-data plan (no broadcasts): the payment-totals join reuses the
    installment_id partitioning; one contract_id exchange feeds both the position
    aggregate and the fact join."""
    b = CreditBook(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(b.fact)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [ln.strip().lstrip("+-: ").strip() for ln in p.splitlines()]
    assert not any(ln.startswith("Exchange hashpartitioning(contract_id") and ln.count("#") > 1 for ln in lines)
    final_agg = next(i for i, ln in enumerate(lines)
                     if "HashAggregate(keys=[contract_id" in ln and "partial_" not in ln)
    assert "partial_" in lines[final_agg + 1]


def test_latest_snapshot_prunes_partitions_at_run_time(spark, tmp_root):
    from ledgerloom.operators.quality import latest_snapshot_slice
    path = os.path.join(tmp_root, "hist")
    TD.installment_history(spark, SF).select("installment_id", "snapshot_date") \
        .write.partitionBy("snapshot_date").parquet(path)
    p = plan(latest_snapshot_slice(spark.read.parquet(path)))
    scan = [ln for ln in p.splitlines() if "FileScan" in ln and "installment_id" in ln][0]
    assert "PartitionFilters: [isnotnull(snapshot_date" in scan and "Subquery" in scan


def test_lookups_carry_no_broadcast_hint(spark):
    from ledgerloom.plans.joins import lookup_join
    joined = lookup_join(spark.range(10), spark.range(5), "id")
    assert "broadcast" not in joined._jdf.queryExecution().analyzed().toString().lower()


def test_newest_slice_needs_no_scan_to_find(spark, tmp_root):
    """The newest snapshot comes from the list of partitions, and the slice's plan names it."""
    from ledgerloom.sinks import tables as TB
    name, loc = "newest_" + os.path.basename(tmp_root).replace("-", "_"), os.path.join(tmp_root, "t")
    schema = "id bigint, snapshot_date date"
    TB.ensure_table(spark, name, spark.createDataFrame([], schema).schema, partition_by=["snapshot_date"], location=loc)
    assert TB.newest_partition(spark, name, "snapshot_date") is None and TB.newest_slice(spark, name, "snapshot_date").isEmpty()
    for day in (dt.date(1999, 12, 31), dt.date(2000, 1, 31), dt.date(2000, 1, 1)):
        TB.replace_snapshot(spark.createDataFrame([(day.day, day)], schema), name, "snapshot_date", day)
    p = plan(TB.newest_slice(spark, name, "snapshot_date"))
    assert "snapshot_date" in p and "= 2000-01-31" in p and "Subquery" not in p and "Exchange" not in p
    assert [r.id for r in TB.newest_slice(spark, name, "snapshot_date").collect()] == [31]
    found = plan(spark.sql(f"SHOW PARTITIONS {name}"))
    assert "Scan parquet" not in found and "FileScan" not in found


def test_exact_distinct_counts_shuffle_bitmaps(spark):
    from pyspark.sql import functions as F

    from ledgerloom.operators import checks as C
    rows = spark.range(50_000).selectExpr("(id * 7919) % 40001 - 20000 AS k", "id % 3 AS part").union(
        spark.createDataFrame([(None, 0)], "k long, part long"))
    maps = C.key_bitmaps(rows, "k", ["part"])
    want = {r.part: r.n for r in rows.groupBy("part").agg(F.count_distinct("k").alias("n")).collect()}
    assert {r.part: r.distinct_keys for r in C.count_keys(maps, ["part"]).collect()} == want
    assert C.count_keys(maps).first()[0] == rows.agg(F.count_distinct("k")).first()[0]
    lines = [ln.strip().lstrip("+-: ") for ln in plan(maps).splitlines()]
    exchange = next(i for i, ln in enumerate(lines) if "Exchange" in ln)
    assert "partial_bitmap_construct_agg" in "".join(lines[exchange + 1:exchange + 4])     # bitmaps before the shuffle
