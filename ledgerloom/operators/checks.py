"""Profiles, persisted quality checks and the publish gate.

Checks are computed Spark-side: each table's metrics come from one aggregate
(not one job per check), are unpivoted into ``(dataset, check_name,
actual_value)`` rows and joined with the expectations. Only the count of
failed ERROR checks reaches the driver, after the results are appended.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.columns import count_if


def profile(df: DataFrame, key: str | None = None, null_cols: Sequence[str] = (),
            range_cols: Sequence[str] = (), extra: dict[str, Column] | None = None) -> DataFrame:
    """One-row profile: rows, distinct keys, NULL counts, min/max of chosen columns."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if key:
        aggs.append(F.count_distinct(key).alias("distinct_keys"))
        aggs.append((F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_rows"))
    aggs += [count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_cols]
    for c in range_cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    return df.agg(*aggs)


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., bucket, keys)``: which integer keys occur, a bitmap for each run of 32,768 of them.

    For keys that lie densely, as ids do: a run takes 4 KB whatever number of rows hold it, and each task makes its
    bitmaps before anything is shuffled. Bitmaps of parts of a table, say of its snapshots, can be kept and merged.
    """
    at = F.col(key).cast("long")
    rows = df.where(F.col(key).isNotNull()).select(*by, F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    return rows.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("keys"))


def count_keys(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., distinct_keys)``: how many keys occur, exactly, in the union of bitmaps of :func:`key_bitmaps`."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("keys").alias("keys"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("keys")).alias("distinct_keys"))


def bronze_metrics(products_raw: DataFrame, contracts_raw: DataFrame) -> DataFrame:
    """Post-load gate metrics of the batch bronze tables (one row)."""
    dup_ids = (contracts_raw.groupBy("contract_id").count().where(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("n")).scalar())
    products = products_raw.agg(F.count(F.lit(1))).scalar()
    return contracts_raw.agg(
        products.alias("products"),
        F.count(F.lit(1)).alias("contracts"),
        dup_ids.alias("duplicated_contract_ids"),
        count_if(F.col("principal_amount") <= 0).alias("invalid_principal_rows"))


@dataclass(frozen=True)
class Check:
    layer: str
    dataset: str
    name: str
    metric: str            # column of the dataset's metric row
    expected: object
    severity: str = "ERROR"
    details: str = ""


def _expected_text(v) -> str:
    return str(v)


def run_checks(spark: SparkSession, metrics: dict[str, DataFrame], checks: Sequence[Check],
               run_id: str, run_ts: _dt.datetime) -> DataFrame:
    """Quality results rows (the 10-column results schema).

    ``metrics``: dataset -> one-row DataFrame of metric columns.
    ``passed`` is the equality of the actual and expected values: as numbers
    where both are (0 equals 0.00), else as text.
    """
    parts = []
    for dataset, m in metrics.items():
        names = list(dict.fromkeys(c.metric for c in checks if c.dataset == dataset))
        if not names:
            continue
        stacked = m.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("string").alias("actual_value"))
            for n in names])).alias("m")).select(F.lit(dataset).alias("dataset"), "m.*")
        parts.append(stacked)
    actual = parts[0]
    for p in parts[1:]:
        actual = actual.unionByName(p)
    spec = spark.createDataFrame(
        [(c.layer, c.dataset, c.name, c.metric, _expected_text(c.expected), c.severity, c.details)
         for c in checks],
        "layer string, dataset string, check_name string, metric string, expected_value string, "
        "severity string, details string")
    j = spec.join(actual, ["dataset", "metric"], "left")
    numbers = [F.col(c).try_cast("decimal(38,10)") for c in ("actual_value", "expected_value")]
    return j.select(
        F.lit(run_id).alias("run_id"), F.lit(run_ts).cast("timestamp").alias("run_timestamp"),
        "layer", "dataset", "check_name",
        F.coalesce(numbers[0] == numbers[1], F.col("actual_value") == F.col("expected_value"),
                   F.lit(False)).alias("passed"),
        "actual_value", "expected_value", "severity", "details")


class SchemaContractError(AssertionError):
    pass


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Schema contract: every required column is present (raise with the missing set)."""
    missing = set(required) - set(df.columns)
    if missing:
        raise SchemaContractError(f"missing required columns: {sorted(missing)}")


def snapshot_counts(df: DataFrame, column: str = "snapshot_date", key: str | None = None) -> DataFrame:
    """Rows (and distinct keys) per snapshot."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if key:
        aggs.append(F.count_distinct(key).alias("distinct_keys"))
    return df.groupBy(column).agg(*aggs)


def pii_exposure(df: DataFrame, pii: Sequence[str] = S.PII_COLUMNS) -> int:
    """How many PII columns a published table exposes (a schema check)."""
    return len(set(df.columns) & set(pii))


def publish_and_gate(results: DataFrame, table: str) -> int:
    """Append the results, then raise if any ERROR check failed (persist first)."""
    results.select(*results.sparkSession.table(table).columns).write.insertInto(table)
    failures = results.where(~F.col("passed") & (F.col("severity") == "ERROR")).count()
    if failures:
        raise AssertionError(f"{failures} critical checks failed")
    return failures


def latest_run(results: DataFrame) -> DataFrame:
    """Rows of the most recent run (``run_timestamp = max``), as a scalar subquery
    instead of an unpartitioned ranking window."""
    last = results.agg(F.max("run_timestamp")).scalar()
    return results.where(F.col("run_timestamp") == last)
