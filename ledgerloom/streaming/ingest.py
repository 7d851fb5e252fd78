"""Incremental, exactly-once file ingestion with Structured Streaming.

``load_new_files`` is the library's "load each file at most once" primitive:
a file-source stream with a declared schema, drained with
``trigger(availableNow=True)`` into an append-only sink. The checkpoint (and
the sink's commit log) remember which files were loaded, so a re-run adds 0
rows, a new file adds exactly its rows, and an executor lost mid-run only
re-does uncommitted micro-batches. Checkpoint and sink must be reset
together (:func:`reset_stream`); a table written this way has exactly one writer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.sources.files import (CSV_LENIENT, CSV_STRICT, _exists, _meta_cols, cast_declared, csv_columns,
                                       delete_folder, parse_with_rescue)

# The file source skips a *new* file whose modification time is older than
# maxFileAge (default 7 days) relative to the newest file it has seen. Back-
# filled deliveries can carry old timestamps, so the filter is set to a
# century: every new file is loaded exactly once. (The seen-files log then
# remembers every file; archive loaded files with ``cleanSource`` to bound it.)
DEFAULT_OPTIONS = {"maxFileAge": "36500d"}


def file_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType,
                partition_cols: T.StructType | None = None, rescue: bool = False,
                strict: bool = True, max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """A typed streaming DataFrame over a landing directory, with file metadata.

    fmt json + rescue: lines are read as text and parsed by
    :func:`parse_with_rescue` (the stream never fails on new or mistyped
    fields). fmt csv: read as text by column name and cast, under the same rules
    as the batch reader; a column that is missing or unknown fails before the start.
    """
    opts = {**DEFAULT_OPTIONS, **options}
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    parts = list(partition_cols.fields) if partition_cols else []
    part_names = [f.name for f in parts]
    reader = spark.readStream.options(**opts)
    if fmt == "json" and rescue:
        raw = reader.schema(T.StructType([T.StructField("value", T.StringType())] + parts)).text(path)
        raw = raw.select("*", *_meta_cols(size=True))
        meta = ["source_file_path", "source_file_name", "source_file_size",
                "source_file_modification_time", "ingested_at"]
        return parse_with_rescue(raw, schema, keep=part_names + meta)
    if fmt == "csv":
        columns = csv_columns(spark, path, schema)
        raw = (reader.schema(T.StructType(columns.fields + parts))
               .options(**(CSV_STRICT if strict else CSV_LENIENT)).csv(path))
        raw = raw.select("*", *_meta_cols(size=True))
        keep = part_names + ["source_file_path", "source_file_name", "source_file_size",
                             "source_file_modification_time", "ingested_at"]
        return cast_declared(raw, schema, strict=strict, keep=keep)
    raw = reader.schema(T.StructType(schema.fields + parts)).format(fmt).load(path)
    return raw.select("*", *_meta_cols(size=True))


def infer_schema(spark: SparkSession, path: str, fmt: str = "json", sampling_ratio: float = 1.0,
                 **options) -> T.StructType:
    """Infer a landing folder's schema once, with a batch read (``samplingRatio``
    bounds the rows looked at), to hand to a stream, which cannot infer."""
    return (spark.read.format(fmt).option("samplingRatio", str(sampling_ratio)).options(**options)
            .load(path).schema)


def inferred_file_stream(spark: SparkSession, path: str, fmt: str = "json", sampling_ratio: float = 1.0,
                         **options) -> DataFrame:
    """A file stream whose schema (partition columns included) is inferred once from a batch sample."""
    schema = infer_schema(spark, path, fmt, sampling_ratio, **options)
    return (spark.readStream.options(**{**DEFAULT_OPTIONS, **options}).schema(schema).format(fmt).load(path)
            .select("*", *_meta_cols(size=True)))


def drain(df: DataFrame, target: str, checkpoint: str, query_name: str | None = None,
          fmt: str = "parquet") -> int:
    """Run the stream to completion (availableNow) into ``target``; return rows added.

    ``target`` is a table name, or a path when it contains a slash.
    """
    return drain_with_progress(df, target, checkpoint, query_name, fmt)["rows"]


def active_streams(spark: SparkSession) -> list[dict]:
    """Name, id and status of the streams running in this session."""
    return [{"name": q.name, "id": q.id, "status": q.status} for q in spark.streams.active]


def drain_with_progress(df: DataFrame, target: str, checkpoint: str, query_name: str | None = None,
                        fmt: str = "parquet") -> dict:
    """Like :func:`drain`, returning the rows added and the last progress report."""
    before = _rows(df.sparkSession, target, df.schema, fmt)
    w = (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if query_name:
        w = w.queryName(query_name)
    q = w.format(fmt).start(target) if "/" in target else w.toTable(target)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return {"rows": _rows(df.sparkSession, target, df.schema, fmt) - before, "last_progress": q.lastProgress}


def _rows(spark: SparkSession, target: str, schema: T.StructType, fmt: str = "parquet") -> int:
    """Rows in the sink, from its committed files.

    Progress reports are no source for this: a query keeps the last hundred,
    and they count input lines, not rows written. Parquet counts from footers.
    """
    if "/" in target:
        # the sink's own log tells committed files from those of a failed batch
        logged = _exists(spark, target.rstrip("/") + "/_spark_metadata")
        return spark.read.schema(schema).format(fmt).load(target).count() if logged else 0
    if not spark.catalog.tableExists(target):
        return 0
    spark.catalog.refreshTable(target)
    return spark.table(target).count()


def reset_stream(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Delete the sink and its checkpoint together, so that the next run loads everything again.

    ``target`` is a table name, or a path when it contains a slash. One without
    the other would lose rows or load them twice.
    """
    if "/" in target:
        delete_folder(spark, target)
    elif spark.catalog.tableExists(target):
        from ledgerloom.sinks.tables import table_location
        location = table_location(spark, target)
        spark.sql(f"DROP TABLE {target}")
        delete_folder(spark, location)
    delete_folder(spark, checkpoint)


def load_new_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType, target: str,
                   checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                   partition_cols: T.StructType | None = None, rescue: bool = False,
                   strict: bool = True, query_name: str | None = None,
                   max_files_per_trigger: int | None = 1000, **options) -> int:
    """Load every file under ``path`` not loaded before into ``target``; rows added.

    A backlog is loaded in micro-batches of ``max_files_per_trigger`` files, each committed on its own.
    """
    df = file_stream(spark, path, fmt, schema, partition_cols=partition_cols, rescue=rescue,
                     strict=strict, max_files_per_trigger=max_files_per_trigger, **options)
    if transform is not None:
        df = transform(df)
    return drain(df, target, checkpoint, query_name=query_name)
