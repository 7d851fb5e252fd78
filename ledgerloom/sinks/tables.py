"""Namespaces, declared tables and the write semantics of the product.

Tables are Parquet tables in the session catalog. Transactional features the
product relies on are re-expressed with open-source Spark:

* snapshot replacement (``replaceWhere``) -> table partitioned by the snapshot
  column; the new slice is written beside the table and its partition pointed at it;
* ``MERGE`` -> :func:`ledgerloom.operators.merge.sync_merge_plan`, decided
  first on (key, hash) only; changed rows are staged next to the target (a
  table cannot be overwritten while it is read) and put in place -- the whole
  table by pointing it at a finished new folder, a key-bucket partitioned table
  by overwriting only the changed buckets. A failed run leaves the old rows and
  is safe to re-run.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import merge as M
from ledgerloom.session import scratch_dir
from ledgerloom.sources.files import delete_folder, folder_names


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_namespaces(spark: SparkSession, names: dict[str, str], location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` with a comment for each layer."""
    for name, comment in names.items():
        loc = f" LOCATION {_q(location.rstrip('/') + '/' + name + '.db')}" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT {_q(comment)}{loc}")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, comment: str = "",
                 props: dict | None = None, partition_by: Sequence[str] = (),
                 location: str | None = None, allow_new_columns: bool = False) -> None:
    """Declare a Parquet table once; afterwards enforce the schema policy.

    An existing table with other columns is an error unless
    ``allow_new_columns`` (then missing columns are added). A column of another
    type is always an error.
    """
    if spark.catalog.tableExists(name):
        have = {f.name: f.dataType for f in spark.table(name).schema.fields}
        changed = [f.name for f in schema.fields if f.name in have and have[f.name].simpleString() != f.dataType.simpleString()]
        if changed:
            raise ValueError(f"{name}: other types in columns {changed}")
        new = [f for f in schema.fields if f.name not in have]
        if new and not allow_new_columns:
            raise ValueError(f"{name}: unexpected new columns {[f.name for f in new]}")
        if new:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION {_q(location)}" if location else ""
    tprops = ""
    if props:
        tprops = " TBLPROPERTIES (" + ", ".join(f"{_q(k)} = {_q(str(v))}" for k, v in props.items()) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts}{loc}"
              f" COMMENT {_q(comment)}{tprops}")


def set_table_properties(spark: SparkSession, name: str, comment: str | None = None,
                         props: dict | None = None) -> None:
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_q(comment)}")
    if props:
        kv = ", ".join(f"{_q(k)} = {_q(str(v))}" for k, v in props.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({kv})")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE TABLE EXTENDED``: columns, then comment, location, properties."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def table_location(spark: SparkSession, name: str) -> str:
    rows = describe_table(spark, name).where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


@contextlib.contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def replace_table(df: DataFrame, name: str, comment: str | None = None, props: dict | None = None,
                  schema: T.StructType | None = None) -> None:
    """Full rebuild of a table: declared types, comment and properties included.

    Columns are cast to ``schema`` if given. A comment or properties not given
    are those the table had.
    """
    spark = df.sparkSession
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if spark.catalog.tableExists(name):
        comment = spark.catalog.getTable(name).description if comment is None else comment
        props = {**table_properties(spark, name), **(props or {})}
    with _conf(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
    set_table_properties(spark, name, comment, props)


def _literal(value) -> str:
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return _q(value)
    return str(value)


def newest_partition(spark: SparkSession, table: str, column: str):
    """The greatest value of a table's first partition column, from the catalog's list of partitions; None without any.

    No file is opened. Loads drop the partition of an empty slice, so that each has rows.
    """
    kind = spark.table(table).schema[column].dataType
    named = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1).alias("v")).where("v <> '__HIVE_DEFAULT_PARTITION__'")
    return named.agg(F.max(F.col("v").cast(kind))).first()[0]


def newest_slice(spark: SparkSession, table: str, column: str) -> DataFrame:
    """The rows of a table's newest partition; the other partitions are not planned."""
    return spark.table(table).where(F.col(column) == F.lit(newest_partition(spark, table, column)))


def drop_partition(spark: SparkSession, table: str, column: str, value) -> None:
    """Remove a partition and its files (tables with a LOCATION keep files otherwise)."""
    spec = f"PARTITION ({column} = {_literal(value)})"
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        return
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").where("col_name = 'Location'").collect()
    for r in rows[:1]:       # the partition's own location comes first
        delete_folder(spark, r["data_type"])
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")


def replace_snapshot(df: DataFrame, table: str, column: str, value, gate: Callable[[DataFrame], None] | None = None) -> int:
    """Replace the ``column = value`` slice, a partition, as a whole; other slices stay. Returns its rows.

    The input is evaluated once: it is written beside the table, and the same
    write counts its rows and those that do not carry ``value``. ``gate`` may
    then look at the written slice and raise. Only after that is the partition
    pointed at the new folder: a reader sees the old slice or the new one, and a
    run that fails leaves the old one. The folder replaced stays until the next
    replacement, for readers that are at it. An empty input drops the partition.
    """
    spark = df.sparkSession
    wrong = F.count(F.when(~F.col(column).eqNullSafe(F.lit(value)), 1))
    slices = f"{table_location(spark, table).rstrip('/')}__slices/{column}={value}"
    new, seen = f"{slices}/{uuid.uuid4().hex[:12]}", Observation()
    own = spark.table(table).drop(column).schema
    try:
        (df.select(*own.fieldNames(), column).observe(seen, F.count(F.lit(1)).alias("rows"), wrong.alias("wrong"))
         .drop(column).write.parquet(new))
        if seen.get["wrong"]:
            raise ValueError(f"rows outside {column} = {value!r}")
        if gate is not None:
            gate(spark.read.schema(own).parquet(new).withColumn(column, F.lit(value)))
    except BaseException:
        delete_folder(spark, new)
        raise
    if not seen.get["rows"]:
        drop_partition(spark, table, column, value)
        delete_folder(spark, slices)
        return 0
    spec, old = f"PARTITION ({column} = {_literal(value)})", None
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION {_q(new)}")
    else:
        old = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").where("col_name = 'Location'").first()["data_type"]
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {_q(new)}")
    spark.catalog.refreshTable(table)
    for name in folder_names(spark, slices):
        if name not in (new.rsplit("/", 1)[1], (old or "").rstrip("/").rsplit("/", 1)[-1]):
            delete_folder(spark, f"{slices}/{name}")
    return int(seen.get["rows"])


def append_table(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=False)


def merge_bucket(key: str, buckets: int):
    """Bucket of a key for bucket-partitioned merge targets."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def apply_sync_merge(spark: SparkSession, table: str, source: DataFrame, key: str,
                     hash_col: str = "record_hash", bucket_col: str | None = None,
                     buckets: int | None = None) -> dict[str, int]:
    """Synchronise ``table`` with ``source``; returns rows per action.

    The source is evaluated once, into a stage; several source rows for one
    target row are an error before anything is counted or written.

    Whole table (no ``bucket_col``): actions are decided on (key, hash) only;
    when nothing changed the table is left untouched. Otherwise the new state is
    written to a new folder, the table is pointed at it once it is complete, and
    the old folder is removed.

    Bucket-partitioned (``bucket_col`` = ``merge_bucket(key, buckets)``):
      1. actions are decided on (key, hash, bucket) only -- a columnar read of
         three columns of the target -- giving the counts and the changed
         buckets (at most ``buckets`` values reach the driver); nothing is written;
      2. only the changed buckets are merged: their target partitions are read
         (partition pruning), merged with the matching source rows, staged, and
         written back by dynamic partition overwrite. Unchanged buckets are
         neither read in full nor rewritten.
    """
    stage = scratch_dir(spark, "merge-source")
    if bucket_col is not None:
        source = source.withColumn(bucket_col, merge_bucket(key, buckets))
    source.write.parquet(stage)
    source = spark.read.schema(source.schema).parquet(stage)
    try:
        again = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not again.join(spark.table(table).select(key), key, "left_semi").isEmpty():
            raise M.MergeCardinalityError("several source rows match one target row")
        return (_merge_whole(spark, table, source, key, hash_col) if bucket_col is None
                else _merge_buckets(spark, table, source, key, hash_col, bucket_col))
    finally:
        delete_folder(spark, stage)


def _merge_buckets(spark: SparkSession, table: str, source: DataFrame, key: str, hash_col: str, bucket_col: str) -> dict:
    target = spark.table(table)
    slim = M.sync_merge_plan(target.select(key, hash_col, bucket_col),
                             source.select(key, hash_col, bucket_col), key, hash_col)
    per_bucket = slim.groupBy(bucket_col, "_action").agg(F.count(F.lit(1)).alias("rows")).collect()
    counts = {a: 0 for a in (M.INSERT, M.UPDATE, M.DELETE, M.KEEP)}
    changed = set()
    for r in per_bucket:
        counts[r["_action"]] += int(r["rows"])
        if r["_action"] != M.KEEP:
            changed.add(r[bucket_col])
    if not changed:
        return counts
    in_changed = F.col(bucket_col).isin(sorted(changed))
    plan = M.sync_merge_plan(target.where(in_changed), source.where(in_changed), key, hash_col)
    stage = scratch_dir(spark, "merge-stage")
    plan.write.parquet(stage)
    staged = spark.read.parquet(stage)
    state = M.merged_state(staged).select(*target.columns)
    # rebalance: rows of a bucket go to few tasks (few files); AQE still splits a large bucket
    with _conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        state.hint("rebalance", bucket_col).write.insertInto(table, overwrite=True)
    kept = {r[0] for r in state.select(bucket_col).distinct().collect()}
    for b in changed - kept:   # every row of the bucket was deleted
        drop_partition(spark, table, bucket_col, int(b))
    delete_folder(spark, stage)
    return counts


def _merge_whole(spark: SparkSession, table: str, source: DataFrame, key: str, hash_col: str) -> dict:
    target = spark.table(table)
    slim = M.sync_merge_plan(target.select(key, hash_col), source.select(key, hash_col), key, hash_col)
    rows = {r["action"]: int(r["rows"]) for r in M.action_counts(slim).collect()}
    counts = {a: rows.get(a, 0) for a in (M.INSERT, M.UPDATE, M.DELETE, M.KEEP)}
    if not any(counts[a] for a in (M.INSERT, M.UPDATE, M.DELETE)):
        return counts   # nothing to write
    # the new state lives beside the old one (same shared storage) until it is complete
    old = table_location(spark, table).rstrip("/")
    new = f"{old.split('__state-')[0]}__state-{uuid.uuid4().hex[:12]}"
    M.merged_state(M.sync_merge_plan(target, source, key, hash_col)).select(*target.columns).write.parquet(new)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_q(new)}")
    spark.catalog.refreshTable(table)
    delete_folder(spark, old)
    return counts


def load_ledger(bronze: DataFrame, label: str | None = None) -> DataFrame:
    """Per source file: rows, modification time and first/last ingestion."""
    g = bronze.groupBy("source_file_path").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("source_file_modification_time").alias("file_modification_time"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"))
    return g.withColumn("label", F.lit(label)) if label is not None else g
