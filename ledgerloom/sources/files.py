"""File sources with declared schemas.

All readers work the same in batch and in Structured Streaming where the
format allows it: they take a reader (``spark.read`` or ``spark.readStream``)
or build one, and only use column expressions afterwards.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def cast_declared(df: DataFrame, schema: T.StructType, strict: bool = True,
                  rescued: str | None = "_rescued_data", keep: Sequence[str] = ()) -> DataFrame:
    """Cast string columns to the declared types.

    strict: ANSI ``cast`` -- a value that does not fit fails the job (a failed
    load, nothing half-written). Non-strict: ``try_cast`` and the raw text of
    every column that failed goes to ``rescued`` as a JSON object.
    """
    typed = []
    failed = []
    for f in schema.fields:
        raw = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            typed.append(raw.alias(f.name))
            continue
        val = raw.cast(f.dataType) if strict else raw.try_cast(f.dataType)
        typed.append(val.alias(f.name))
        if not strict:
            failed.append(F.when(raw.isNotNull() & val.isNull(), F.struct(F.lit(f.name).alias("k"),
                                                                           raw.alias("v"))))
    extra = [F.col(c) for c in keep]
    if strict or rescued is None:
        return df.select(*typed, *extra)
    entries = F.filter(F.array(*failed), lambda e: e.isNotNull()) if failed else F.array()
    rescue = F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(entries)))
    return df.select(*typed, rescue.alias(rescued), *extra)


def csv_columns(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The declared columns as text, in the order of the landing folder's header.

    Only a header is read. A missing or an unknown column is an error. The
    readers then check every file against this order (``enforceSchema=false``),
    so files of one folder with different headers fail instead of mixing values.
    """
    found = spark.read.option("header", True).csv(path)
    header = [c for c in found.columns if c not in _partition_names(path, found)]
    missing, unknown = set(schema.fieldNames()) - set(header), set(header) - set(schema.fieldNames())
    if missing or unknown or len(header) != len(schema):
        raise ValueError(f"{path}: missing columns {sorted(missing)}, unknown columns {sorted(unknown)}")
    return T.StructType([T.StructField(c, T.StringType()) for c in header])


def _partition_names(path: str, found: DataFrame) -> set[str]:
    """Partition columns that the reader found in the folders below ``path`` (from the first file's path)."""
    first = found.select("_metadata.file_path").limit(1).collect()
    below = first[0][0].split(path.rstrip("/").split("/")[-1], 1)[-1] if first else ""
    return {x.split("=", 1)[0] for x in below.split("/")[:-1] if "=" in x}


#: Header names are checked in every file, and ragged rows fail the load.
CSV_STRICT = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"}
#: The same header check; values that do not fit are rescued, not failed.
CSV_LENIENT = {"header": "true", "enforceSchema": "false"}


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in the first line of a CSV file, through the cluster's file system; () for an empty file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([line.lstrip("﻿")]), ())) if line else ()


def read_by_header(spark: SparkSession, root: str, files: list[str], schema: T.StructType,
                   partition_cols: T.StructType | None = None, strict: bool = True, rescued: str | None = "_rescued_data",
                   metadata: bool = True) -> DataFrame | None:
    """CSV files below ``root``, by column name: a reader for each order of the columns, and their union.

    Only the first line of each file is looked at here. Partition columns are found in the folders; ``partition_cols``
    gives their types. None where no file has a line.
    """
    with ThreadPoolExecutor(8) as pool:
        headers = list(pool.map(lambda f: header(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers):
        if names:
            groups.setdefault(names, []).append(file)
    declared = schema.fieldNames()
    for names, held in groups.items():
        if sorted(names) != sorted(declared):
            raise ValueError(f"{held[0]}: missing columns {sorted(set(declared) - set(names))}, "
                             f"unknown columns {sorted(set(names) - set(declared))}")
    parts = list(partition_cols.fields) if partition_cols else []
    out = None
    for names, held in sorted(groups.items()):
        columns = T.StructType([T.StructField(c, T.StringType()) for c in names] + parts)
        raw = spark.read.schema(columns).options(**(CSV_STRICT if strict else CSV_LENIENT)).option("basePath", root).csv(held)
        keep = [c for c in raw.columns if c not in declared]
        meta = _meta_cols(size=True) if metadata else []
        raw = raw.select("*", *meta)
        rows = cast_declared(raw, schema, strict=strict, rescued=rescued, keep=[*keep, *raw.columns[len(declared) + len(keep):]])
        out = rows if out is None else out.unionByName(rows)
    return out


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True,
                   rescued: str | None = "_rescued_data", metadata: bool = True, mixed: bool = False) -> DataFrame:
    """CSV with header, read as text by column name and cast to ``schema``.

    Partition directories below ``path`` (``batch_date=...``) are discovered. One header stands for all files, which
    are checked against it; with ``mixed`` every file is read by its own (the listing and the headers reach the driver).
    """
    if mixed:
        files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").orderBy("path").collect()]
        found = read_by_header(spark, path, files, schema, strict=strict, rescued=rescued, metadata=metadata)
        if found is None:
            raise ValueError(f"{path}: no file has a header")
        return found.drop("source_file_size")
    columns = csv_columns(spark, path, schema)
    raw = spark.read.schema(columns).options(**(CSV_STRICT if strict else CSV_LENIENT)).csv(path)
    parts = [c for c in raw.columns if c not in schema.fieldNames()]
    if metadata:
        raw = with_source_metadata(raw)
        parts += ["source_file_path", "source_file_name", "source_file_modification_time", "ingested_at"]
    return cast_declared(raw, schema, strict=strict, rescued=rescued, keep=parts)


def read_permissive_json(spark: SparkSession, path: str, schema: T.StructType,
                         corrupt: str = "corrupt_record", metadata: bool = True) -> DataFrame:
    """JSON with an explicit schema; malformed lines are kept in ``corrupt``.

    Note: Spark rejects a query that touches *only* the corrupt column, so the
    result always carries the declared columns too.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(with_corrupt).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    cols = [F.col(f.name) for f in schema.fields]
    meta = _meta_cols() if metadata else []
    return df.select(*cols, F.col("_corrupt_record").alias(corrupt), *meta)


def read_typed_parquet(spark: SparkSession, path: str, schema: T.StructType,
                       metadata: bool = True, size: bool = True) -> DataFrame:
    """Parquet with every declared column cast (e.g. DOUBLE money -> DECIMAL(18,2))."""
    df = spark.read.parquet(path)
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    meta = _meta_cols(size=size) if metadata else []
    return df.select(*cols, *meta)


def _meta_cols(size: bool = False, ingested_at: bool = True) -> list[Column]:
    cols = [F.col("_metadata.file_path").alias("source_file_path"),
            F.col("_metadata.file_name").alias("source_file_name")]
    if size:
        cols.append(F.col("_metadata.file_size").alias("source_file_size"))
    cols.append(F.col("_metadata.file_modification_time").alias("source_file_modification_time"))
    if ingested_at:
        cols.append(F.current_timestamp().alias("ingested_at"))
    return cols


def with_source_metadata(df: DataFrame, size: bool = False, ingested_at: bool = True) -> DataFrame:
    """Append file path / name / (size) / modification time and the ingestion time."""
    return df.select("*", *_meta_cols(size=size, ingested_at=ingested_at))


def _from_text(raw: Column, dt: T.DataType) -> Column:
    """Typed value of one JSON field given its text (string map value)."""
    if isinstance(dt, T.StringType):
        return raw
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(raw, dt)
    value = raw.try_cast(dt)
    if isinstance(dt, T.DecimalType):     # digits that the scale would round away do not fit
        return F.when(raw.try_cast("decimal(38,18)") == value, value)
    return value


def parse_with_rescue(text_df: DataFrame, schema: T.StructType, rescued: str = "_rescued_data",
                      value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse JSON lines against ``schema`` without ever failing on the data.

    ``rescued`` holds, as a JSON object, every field that is not declared or
    whose value does not fit its declared type (a decimal with too many digits
    after the point included); a line that is not a JSON object at all, or
    repeats a key, is rescued whole. Works in batch and in streams (stateless).

    Each line is parsed once, into a string map; declared fields are cast from
    their text (a quoted number that fits is accepted). The lambdas only touch
    their own arguments, so nothing is re-evaluated per map entry.
    """
    lines = text_df.where(F.trim(F.col(value)) != "")   # blank lines are not records (as in the JSON reader)
    parsed = lines.select(F.col(value).alias("_v"),
                          F.from_json(F.col(value), "map<string,string>").alias("_raw"), *keep)
    typed = parsed.select("_v", "_raw", *keep, *[
        _from_text(F.col("_raw")[f.name], f.dataType).alias(f.name) for f in schema.fields])
    # declared field -> "its typed value is NULL"; undeclared keys are absent
    typed_null = F.create_map(*[x for f in schema.fields
                                for x in (F.lit(f.name), F.col(f.name).isNull())])
    flagged = F.map_zip_with(
        F.col("_raw"), typed_null,
        lambda k, raw_v, is_null: F.struct(
            (is_null.isNull() | (raw_v.isNotNull() & is_null)).alias("keep"), raw_v.alias("v")))
    leftover = F.transform_values(F.map_filter(flagged, lambda k, e: e["keep"]), lambda k, e: e["v"])
    staged = typed.select("_v", "_raw", *keep, *schema.fieldNames(), leftover.alias("_left"))
    keys = F.map_keys("_raw")            # as they stand in the line, repeats included
    repeated = F.size(keys) > F.size(F.array_distinct(keys))
    rescue = (F.when((F.col("_raw").isNull() & F.col("_v").isNotNull()) | repeated, F.col("_v"))
               .when(F.size(F.map_keys(F.col("_left"))) > 0, F.to_json(F.col("_left"))))
    return staged.select(*schema.fieldNames(), rescue.alias(rescued), *keep)


def write_landing(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                  max_records_per_file: int | None = None, if_present: str = "write", **options) -> bool:
    """Write a landing file set; returns whether anything was written.

    The frame's own partitioning decides the number of tasks. Partitioned
    writes use the ``rebalance`` hint (few files per folder, while AQE splits a
    large folder over several tasks); ``max_records_per_file`` bounds a file.
    ``if_present="skip"`` leaves a finished delivery as it is (``_SUCCESS`` is
    there); ``"write"`` regenerates it.
    """
    if if_present not in ("write", "skip"):
        raise ValueError(f"if_present={if_present!r}")
    if if_present == "skip" and _exists(df.sparkSession, path.rstrip("/") + "/_SUCCESS"):
        return False
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        options.setdefault("header", True)
    if max_records_per_file:
        options["maxRecordsPerFile"] = max_records_per_file
    w.options(**options).save(path)
    return True


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the cluster's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, through the cluster's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def preview(spark: SparkSession, path: str, fmt: str, n: int = 10, **options) -> DataFrame:
    """First ``n`` rows of a file set (ad-hoc look at a landing folder; the limit is the point)."""
    return spark.read.format(fmt).options(**options).load(path).limit(n)
