"""Streams of files straight into declared tables, each batch exactly once.

Every row carries ``load_id``, the load's name and the number of its
micro-batch, as the table's first partition column. A batch is written by
overwriting its own partition: one that is run again after a failure, between
its write and the checkpoint's commit or in the middle of the write, puts its
rows in once. Rows are counted by the write itself (``observe``), so that no
load reads the table; the count of a batch goes to a log table under the same
``load_id``, and is replaced there, too, if the batch is run again.

CSV is loaded by column name whatever the column order of each file: a stream
over the folder's listing says which files are new, their headers are read, and
files with equal headers are read together. A column that is missing or unknown,
or a row that does not fit, fails the batch with nothing of it in the table.

A table written this way takes any number of loads with names of their own;
a name stands for one folder and one checkpoint.
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ledgerloom.sinks import tables as TB
from ledgerloom.sources.files import read_by_header
from ledgerloom.streaming.ingest import DEFAULT_OPTIONS, file_stream

LOAD_ID = "load_id"
LOAD_LOG = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("rows_added", T.LongType()), T.StructField("loaded_at", T.TimestampType()),
    T.StructField(LOAD_ID, T.StringType())])
LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                        T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


class BatchHistory(StreamingQueryListener):
    """The progress report of every batch of the queries that run while it listens.

    A query itself keeps the last hundred. Reports come in order, ``ended`` last.
    """

    def __init__(self):
        self._batches: dict[str, dict[int, object]] = {}
        self._ended: dict[str, threading.Event] = {}

    def ended(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def batches(self, run_id, timeout: float = 60.0) -> list:
        """The reports of a finished run, in the order of their batches."""
        if not self.ended(run_id).wait(timeout):
            raise TimeoutError("the query's end was not reported")
        held = self._batches.get(str(run_id), {})
        return [held[k] for k in sorted(held)]

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self._batches.setdefault(str(p.runId), {})[p.batchId] = p

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended(event.runId).set()


def declare_sink(spark: SparkSession, table: str, schema: T.StructType, partition_by=(), **kw) -> None:
    """Declare a table that loads write into: ``schema`` and ``load_id``, by which it is partitioned first."""
    fields = [f for f in schema.fields if f.name != LOAD_ID]
    TB.ensure_table(spark, table, T.StructType([*fields, T.StructField(LOAD_ID, T.StringType())]),
                    partition_by=[LOAD_ID, *partition_by], **kw)


def _put(rows: DataFrame, table: str) -> int:
    """Write rows over the partitions that they belong to; how many they are, counted as they are written."""
    spark, seen = rows.sparkSession, Observation()
    rows = rows.select(*spark.table(table).columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    with TB._conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.insertInto(table, overwrite=True)
    return int(seen.get["rows"])


def log_load(spark: SparkSession, log: str, dataset: str, label: str, rows: int, load_id: str) -> None:
    """One row of a load log; a row of the same ``load_id`` is replaced."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    _put(spark.createDataFrame([(dataset, label, rows, now, load_id)], LOAD_LOG), log)


def drain_into(df: DataFrame, name: str, table: str, checkpoint: str,
               frame: Callable[[SparkSession, DataFrame], DataFrame | None] | None = None, log: str | None = None,
               query_name: str | None = None, written: Callable[[int], None] | None = None) -> dict:
    """Run the stream ``df`` to completion into ``table``: ``{"rows": ..., "batches": {number: rows}, "history": [...]}``.

    ``frame`` makes a batch's rows from it (None: nothing to write). ``written`` is called with a batch's number
    once it is in the table and in the log.
    """
    spark, counts = df.sparkSession, {}

    def put(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = batch if frame is None else frame(session, batch)
        load_id = f"{name}-{number:010d}"
        counts[number] = 0 if rows is None else _put(rows.withColumn(LOAD_ID, F.lit(load_id)), table)
        if log is not None:
            log_load(session, log, name, f"{name} new files", counts[number], load_id)
        if written is not None:
            written(number)

    history = BatchHistory()
    spark.streams.addListener(history)
    try:
        w = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        q = (w.queryName(query_name) if query_name else w).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        reports = history.batches(q.runId)
    finally:
        spark.streams.removeListener(history)
    spark.catalog.refreshTable(table)
    return {"rows": sum(counts.values()), "batches": counts, "history": reports}


def load_files(spark: SparkSession, name: str, path: str, fmt: str, schema: T.StructType, table: str, checkpoint: str,
               partition_cols: T.StructType | None = None, rescue: bool = False, strict: bool = True,
               transform: Callable[[DataFrame], DataFrame] | None = None, log: str | None = None,
               max_files_per_trigger: int = 1000, query_name: str | None = None,
               written: Callable[[int], None] | None = None, **options) -> dict:
    """Load every file under ``path`` that the load ``name`` has not loaded into ``table``; see :func:`drain_into`.

    A backlog is loaded in micro-batches of ``max_files_per_trigger`` files; as many file names, and for CSV the
    files' first lines, reach the driver.
    """
    change = transform or (lambda rows: rows)
    if fmt != "csv":
        df = file_stream(spark, path, fmt, schema, partition_cols=partition_cols, rescue=rescue, strict=strict,
                         max_files_per_trigger=max_files_per_trigger, **options)
        return drain_into(change(df), name, table, checkpoint, log=log, query_name=query_name, written=written)
    listing = (spark.readStream.schema(LISTING).format("binaryFile").load(
        path, **{**DEFAULT_OPTIONS, **options}, maxFilesPerTrigger=max_files_per_trigger).select("path"))

    def frame(session: SparkSession, batch: DataFrame) -> DataFrame | None:
        files = sorted(r.path for r in batch.collect())
        rows = read_by_header(session, path, files, schema, partition_cols, strict)
        return None if rows is None else change(rows)

    return drain_into(listing, name, table, checkpoint, frame=frame, log=log, query_name=query_name, written=written)


def reset_load(spark: SparkSession, name: str, table: str, checkpoint: str) -> None:
    """Take a load's rows out of its table and forget its checkpoint, so that its next run loads every file again."""
    from ledgerloom.sources.files import delete_folder

    first = F.split("partition", "/")[0]
    mine = spark.sql(f"SHOW PARTITIONS {table}").select(first.alias("p")).where(F.col("p").startswith(f"{LOAD_ID}={name}-")).distinct()
    location = TB.table_location(spark, table).rstrip("/")
    for r in mine.collect():                  # one for each batch
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD_ID} = {TB._q(r.p.split('=', 1)[1])})")
        delete_folder(spark, f"{location}/{r.p}")
    delete_folder(spark, checkpoint)
