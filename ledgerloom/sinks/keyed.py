"""Tables kept in step with a source, bucket by bucket (W5, J8): a merge reads and writes what changed.

The table is partitioned by ``_bucket``. For each bucket a summary is kept
beside the table: its rows and a digest of their (key, hash) pairs. The staged
source is summed up the same way, in one aggregation, and a bucket whose
summaries agree is neither read nor written; only the others are merged
(:func:`ledgerloom.operators.merge.sync_merge_plan`).

* *Which rows share a bucket.* Integer keys go in runs of ``span`` consecutive
  keys, so that a delivery that touches few ranges of keys touches few buckets;
  other keys go one by one. Runs are placed by linear hashing.
* *Growth.* The number of buckets follows the rows (``bucket_rows`` a bucket):
  one more bucket splits one existing bucket, and all others stay as they are.
* *Commit.* New contents of buckets are written to a new folder; then the new
  summary is recorded as pending, the partitions are pointed at their new
  folders one after the other, and the summary becomes current. A run that is
  lost before the record leaves the old table; one lost after it is completed by
  the next merge before anything else. Readers see the old or the new rows of a
  bucket, and the files replaced by a merge stay until the next one.

* *Facts.* Counts and sums that checks ask of the whole table are kept in the
  summary, for each bucket, and added up from there (:func:`facts`): a gate after
  a merge does not read the table.

Null keys never match (each run replaces those rows), a null hash on either side
keeps the target's row, and several source rows for one target row are an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import merge as M
from ledgerloom.session import scratch_dir
from ledgerloom.sinks import tables as TB
from ledgerloom.sources.files import delete_folder

BUCKET = "_bucket"
BUCKET_ROWS = 4_000_000
SPAN = 65_536
SUMMARY = T.StructType([
    T.StructField(BUCKET, T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("nulls", T.LongType()),
    T.StructField("xor", T.LongType()), T.StructField("total", T.DecimalType(38, 0)), T.StructField("folder", T.StringType()),
    T.StructField("keys", T.LongType()), T.StructField("facts", T.MapType(T.StringType(), T.DecimalType(38, 2)))])


def declare_keyed(spark: SparkSession, table: str, schema: T.StructType, **kw) -> None:
    """Declare a table for :func:`sync`: ``schema`` and the bucket, by which it is partitioned."""
    TB.ensure_table(spark, table, T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]),
                    partition_by=[BUCKET], **kw)


def bucket_of(slot, buckets: int):
    """Linear hashing: the slot modulo twice the largest power of two, or modulo that power where this bucket does
    not exist yet."""
    half = 1 << (buckets.bit_length() - 1)
    wide = F.pmod(slot, F.lit(2 * half))
    return F.when(wide < buckets, wide).otherwise(F.pmod(slot, F.lit(half))).cast("int")


def parent(bucket: int, buckets: int) -> int:
    """The one of ``buckets`` buckets that rows of a later bucket come from."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def _slot(df: DataFrame, key: str, span: int):
    whole = isinstance(df.schema[key].dataType, (T.IntegerType, T.LongType, T.ShortType))
    return F.xxhash64(F.expr(f"`{key}` div {span}") if whole else F.col(key))


def _kept(key: str, kept: dict[str, Column]) -> list[Column]:
    """The distinct keys and the facts of a bucket."""
    each = [x for name, value in sorted(kept.items()) for x in (F.lit(name), F.coalesce(value, F.lit(0)).cast("decimal(38,2)"))]
    none = F.lit(None).cast("map<string,decimal(38,2)>")
    return [F.count_distinct(key).alias("keys"), (F.create_map(*each) if each else none).alias("facts")]


def _summed(rows: DataFrame, key: str, hash_col: str, *more: Column) -> DataFrame:
    return rows.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(key).isNull(), 1)).alias("nulls"),
        F.bit_xor(F.xxhash64(key, hash_col)).alias("xor"),
        F.sum(F.xxhash64(F.lit(1), hash_col, key).cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"), *more)


def summary(spark: SparkSession, table: str) -> tuple[DataFrame, int]:
    """The current summary, one row a bucket, and the number of buckets (0: never merged)."""
    props = TB.table_properties(spark, table)
    if not props.get("merge.summary"):
        return spark.createDataFrame([], SUMMARY), 0
    return spark.read.schema(SUMMARY).parquet(props["merge.summary"]), int(props["merge.buckets"])


def _publish(spark: SparkSession, table: str) -> None:
    """Complete the recorded merge, if there is one. Every step may be run again."""
    props = TB.table_properties(spark, table)
    record = props.get("merge.pending")
    if not record:
        return
    new, old = spark.read.schema(SUMMARY).parquet(record), summary(spark, table)[0]
    moved = new.alias("n").join(old.alias("o"), BUCKET, "left").where("n.folder IS DISTINCT FROM o.folder").select(
        BUCKET, "n.folder").collect()                       # as many as buckets changed
    known = {int(r.partition.split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for bucket, folder in moved:
        spec = f"PARTITION ({BUCKET} = {bucket})"
        if folder is None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
        elif bucket in known:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {TB._q(folder)}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION {TB._q(folder)}")
    TB.set_table_properties(spark, table, props={
        "merge.previous": props.get("merge.summary", ""), "merge.summary": record, "merge.buckets": props["merge.next_buckets"],
        "merge.pending": ""})
    spark.catalog.refreshTable(table)


def _discard_replaced(spark: SparkSession, table: str) -> None:
    """Delete the folders that the merge before replaced, and its summary."""
    before = TB.table_properties(spark, table).get("merge.previous")
    if not before:
        return
    now = summary(spark, table)[0].select("folder")
    gone = spark.read.schema(SUMMARY).parquet(before).select("folder").where("folder IS NOT NULL").join(now, "folder", "left_anti")
    for r in gone.collect():
        delete_folder(spark, r.folder)
    TB.set_table_properties(spark, table, props={"merge.previous": ""})
    delete_folder(spark, before)


def sync(spark: SparkSession, table: str, source: DataFrame, key: str, hash_col: str = "record_hash",
         span: int = SPAN, bucket_rows: int = BUCKET_ROWS, kept: dict[str, Column] | None = None) -> dict[str, int]:
    """Synchronise ``table`` with ``source``: rows for each action, and how many ``buckets`` there are and how many
    were ``read`` and ``written``. ``kept``: counts or sums over the table's rows to keep for :func:`facts`; a merge
    with others than the one before adds those up from the table, once."""
    _publish(spark, table)
    _discard_replaced(spark, table)
    kept = kept or {}
    old, had = summary(spark, table)
    names = old.where("rows > 0").select(F.map_keys("facts")).first()
    if names is not None and sorted(names[0] or []) != sorted(kept):
        again = spark.table(table).groupBy(BUCKET).agg(*_kept(key, kept))
        old = old.drop("keys", "facts").join(again, BUCKET, "left").select(*SUMMARY.fieldNames())
        record = f"{TB.table_location(spark, table).rstrip('/')}__summaries/{uuid.uuid4().hex[:12]}"
        old.coalesce(1).write.parquet(record)
        TB.set_table_properties(spark, table, props={"merge.summary": record})
        old = spark.read.schema(SUMMARY).parquet(record)
    columns = [c for c in spark.table(table).columns if c != BUCKET]
    root, version = TB.table_location(spark, table).rstrip("/"), uuid.uuid4().hex[:12]
    stage, seen = scratch_dir(spark, "merge-source"), Observation()
    try:
        source.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(stage)
        staged = spark.read.schema(spark.table(table).select(*columns).schema).parquet(stage)
        buckets = max(had, -(-int(seen.get["rows"]) // bucket_rows), 1)
        split = {parent(b, had) for b in range(had, buckets)} if had else set()
        staged = staged.withColumn(BUCKET, bucket_of(_slot(staged, key, span), buckets))

        # buckets whose summaries differ, or that hold null keys or repeated keys
        sums = _summed(staged, key, hash_col)
        differ = sums.alias("s").join(old.alias("o"), BUCKET, "full_outer").where(
            "coalesce(s.rows, 0) <> coalesce(o.rows, 0) OR s.xor IS DISTINCT FROM o.xor OR s.total IS DISTINCT FROM o.total"
            " OR s.nulls > 0 OR o.nulls > 0").select(BUCKET)
        again = staged.groupBy(key, BUCKET).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        changed = {r[0] for r in differ.union(again.select(BUCKET)).distinct().collect()} | split | set(range(had, buckets))
        read = sorted(b for b in changed if b < had)
        same = old.where(~F.col(BUCKET).isin(sorted(changed))).agg(F.sum("rows")).first()[0] or 0
        counts = {M.INSERT: 0, M.UPDATE: 0, M.DELETE: 0, M.KEEP: int(same), "buckets": buckets, "read": len(read), "written": 0}
        if not changed:
            return counts

        target = spark.table(table).where(F.col(BUCKET).isin(read)).select(*columns)
        if not again.join(target.select(key), key, "left_semi").isEmpty():
            raise M.MergeCardinalityError("several source rows match one target row")
        merged = M.sync_merge_plan(target, staged.where(F.col(BUCKET).isin(sorted(changed))).select(*columns), key, hash_col)
        merged = merged.withColumn(BUCKET, bucket_of(_slot(merged, key, span), buckets))
        plan = scratch_dir(spark, "merge-plan")
        merged.write.parquet(plan)
        merged = spark.read.schema(merged.schema).parquet(plan)
        actions = merged.groupBy(BUCKET, "_action").agg(F.count(F.lit(1)).alias("n")).collect()
        for r in actions:
            counts[r["_action"]] += int(r["n"])
        write = {r[BUCKET] for r in actions if r["_action"] != M.KEEP} | split | set(range(had, buckets))
        counts["written"] = len(write)
        if not write:
            delete_folder(spark, plan)
            return counts

        folder = f"{root}__versions/{version}"
        state = M.merged_state(merged.where(F.col(BUCKET).isin(sorted(write))))
        # rebalance: rows of a bucket go to few tasks (few files); AQE still splits a large bucket
        state.select(*columns, BUCKET).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        new = spark.read.schema(T.StructType([*spark.table(table).select(*columns).schema.fields,
                                              T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
        new = _summed(new, key, hash_col, *_kept(key, kept)).withColumn("folder", F.concat(F.lit(f"{folder}/{BUCKET}="), F.col(BUCKET).cast("string")))
        emptied = spark.createDataFrame([(b,) for b in sorted(write)], f"{BUCKET} int").join(new, BUCKET, "left_anti").select(
            BUCKET, F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("nulls"), F.lit(None).cast("long").alias("xor"),
            F.lit(None).cast("decimal(38,0)").alias("total"), F.lit(None).cast("string").alias("folder"),
            F.lit(0).cast("long").alias("keys"), F.lit(None).cast("map<string,decimal(38,2)>").alias("facts"))
        names = SUMMARY.fieldNames()
        whole = old.where(~F.col(BUCKET).isin(sorted(write))).select(*names).unionByName(new.select(*names)).unionByName(emptied)
        record = f"{root}__summaries/{version}"
        whole.coalesce(1).write.parquet(record)
        TB.set_table_properties(spark, table, props={"merge.pending": record, "merge.next_buckets": str(buckets)})
        _publish(spark, table)
        delete_folder(spark, plan)
        return counts
    finally:
        delete_folder(spark, stage)


def facts(spark: SparkSession, table: str, *names: str) -> DataFrame:
    """``rows``, ``distinct_keys``, ``duplicate_rows`` and the facts named, of the whole table, from its summary (one row)."""
    _publish(spark, table)
    held = summary(spark, table)[0]
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in ("rows", "keys")]
    return held.agg(total[0].alias("rows"), total[1].alias("distinct_keys"), (total[0] - total[1]).alias("duplicate_rows"),
                    *[F.coalesce(F.sum(F.col("facts")[n]), F.lit(0)).cast("decimal(38,2)").alias(n) for n in names])


def files_of(spark: SparkSession, table: str, buckets: Sequence[int] | None = None) -> set[str]:
    """The data files of a table, or of some of its buckets."""
    rows = spark.table(table)
    return set((rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))).inputFiles())
