"""JSON loads whose table grows with the deliveries.

The table's own schema is what lines are parsed by, so that it is kept between
runs and nothing that was loaded is read again to find it. With ``infer`` the
new files of a batch are looked at before they are parsed, and fields that the
table does not have become columns; without it such fields are rescued, until
:func:`promote` makes a column of one: rows that hold it are filled in, later
loads parse it. A column keeps its type; a value that does not fit is rescued.
Objects and arrays are columns of JSON text, so that none of their fields is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import scratch_dir
from ledgerloom.sinks import tables as TB
from ledgerloom.sources.files import _meta_cols, delete_folder, parse_with_rescue
from ledgerloom.streaming.ingest import DEFAULT_OPTIONS
from ledgerloom.streaming.tables import LISTING, LOAD_ID, _put, declare_sink, drain_into

RESCUED = "_rescued_data"
META = T.StructType([
    T.StructField("source_file_path", T.StringType()), T.StructField("source_file_name", T.StringType()),
    T.StructField("source_file_size", T.LongType()), T.StructField("source_file_modification_time", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType())])
#: Types that a rescued field may be given, the first that fits all its values.
CANDIDATES = ["bigint", "double", "date", "timestamp", "boolean"]


def _flat(schema: T.StructType) -> list[T.StructField]:
    """Fields of a line; objects and arrays as text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.NullType)
    return [T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType) for f in schema.fields]


def _payload(spark: SparkSession, table: str, partition_cols: T.StructType) -> T.StructType:
    """The columns of a table that come from the lines."""
    own = {RESCUED, LOAD_ID, *META.fieldNames(), *partition_cols.fieldNames()}
    return T.StructType([f for f in spark.table(table).schema.fields if f.name not in own])


def declare_growing(spark: SparkSession, table: str, schema: T.StructType, partition_cols: T.StructType | None = None, **kw) -> None:
    """Declare a table for :func:`load_growing`: ``schema`` (it may be empty of fields), rescued data, file metadata."""
    parts = partition_cols or T.StructType([])
    declare_sink(spark, table, T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType()), *META.fields, *parts.fields]),
                 partition_by=parts.fieldNames(), **kw)


def _widen(spark: SparkSession, table: str, found: list[T.StructField], partition_cols: T.StructType) -> None:
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in found if f.name.lower() not in have]
    if new:
        kept = [f for f in spark.table(table).schema.fields if f.name not in (LOAD_ID, *partition_cols.fieldNames())]
        TB.ensure_table(spark, table, T.StructType([*kept, *new]), allow_new_columns=True)
        spark.catalog.refreshTable(table)


def load_growing(spark: SparkSession, name: str, path: str, table: str, checkpoint: str, infer: bool = False,
                 partition_cols: T.StructType | None = None, log: str | None = None, max_files_per_trigger: int = 1000) -> dict:
    """Load every new file of JSON lines under ``path`` into ``table``, as :func:`drain_into` does."""
    parts = partition_cols or T.StructType([])
    listing = (spark.readStream.schema(LISTING).format("binaryFile").load(
        path, **DEFAULT_OPTIONS, maxFilesPerTrigger=max_files_per_trigger).select("path"))

    def frame(session: SparkSession, batch: DataFrame) -> DataFrame:
        files = sorted(r.path for r in batch.collect())
        if infer:        # the new files alone
            _widen(session, table, _flat(session.read.json(files).schema), parts)
        lines = session.read.schema(T.StructType([T.StructField("value", T.StringType()), *parts.fields]))
        lines = lines.option("basePath", path).text(files).select("*", *_meta_cols(size=True))
        return parse_with_rescue(lines, _payload(session, table, parts), RESCUED, keep=[*META.fieldNames(), *parts.fieldNames()])

    return drain_into(listing, name, table, checkpoint, frame=frame, log=log)


def rescued_fields(rows: DataFrame) -> DataFrame:
    """``(field, rows, type)`` of the fields in rescued data: how often each occurs and the type that all its values fit."""
    each = rows.select(F.explode(F.from_json(RESCUED, "map<string,string>")).alias("field", "value"))
    said = F.count("value")
    fits = [F.when((said > 0) & (F.count(F.col("value").try_cast(t)) == said), t) for t in CANDIDATES]
    return each.groupBy("field").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(*fits, F.lit("string")).alias("type"))


def promote(spark: SparkSession, table: str, field: str, dtype: str) -> int:
    """Make a column of a rescued field and fill it in; returns how many rows had the field.

    Only the batches that hold the field are rewritten, each over its own partitions, so that a run that is lost is
    completed by another. A value that does not fit ``dtype`` stays where it is.
    """
    if field not in spark.table(table).columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{field}` {dtype})")
        spark.catalog.refreshTable(table)
    rows = spark.table(table)
    left = F.from_json(RESCUED, "map<string,string>")
    held = rows.where(F.map_contains_key(left, F.lit(field)))
    batches = [r[0] for r in held.select(LOAD_ID).distinct().collect()]
    if not batches:
        return 0
    said = left[field]
    fits = F.map_contains_key(left, F.lit(field)) & (said.isNull() | said.try_cast(dtype).isNotNull())
    rest = F.map_filter(left, lambda k, v: k != field)
    n, stage = held.count(), scratch_dir(spark, "promote")
    changed = rows.where(F.col(LOAD_ID).isin(batches)).select(*[
        F.when(fits, said.try_cast(dtype)).otherwise(F.col(c)).alias(c) if c == field else
        F.when(fits, F.when(F.size(rest) > 0, F.to_json(rest))).otherwise(F.col(c)).alias(c) if c == RESCUED else F.col(c)
        for c in rows.columns])
    changed.write.parquet(stage)
    _put(spark.read.schema(rows.schema).parquet(stage), table)
    delete_folder(spark, stage)
    spark.catalog.refreshTable(table)
    return n
