"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import re
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import scratch_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col):
    """Lower-case A-Z and nothing else (Unicode letters keep their case)."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(folder: str):
    """The file system of a folder's URI and the folder's path on it; the same on every machine."""
    from pyarrow import fs

    folder = re.sub(r"^file:/+", "file:///", folder)
    return fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    A job that was submitted with the package in ``--py-files`` runs from an
    archive already, and nothing is sent.
    """
    app = spark.sparkContext.applicationId
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if app in _SHIPPED or not os.path.isdir(root):
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(x for x in names if x.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    folder = scratch_dir(spark, "code")
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/ledgerloom.zip", compression=None) as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/ledgerloom.zip")
    _SHIPPED.add(app)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: later stages survive lost executors without running the
    earlier ones again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame of :func:`materialize` that is no longer needed."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of an undirected graph, by alternating star contraction.

    ``edges`` has columns ``a`` and ``b`` of one orderable type. Returns
    ``(node, root)`` for every node other than the smallest of its component;
    a node with no edge has no row. Each round links every node to the smallest
    neighbour it knows, with two aggregations and two joins, and is written to
    the shared folder. Only an edge count and a checksum reach the driver.
    """
    def written(df):
        out = materialize(df, label)
        row = out.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        return out, tuple(row)

    e, mark = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct())
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large, label)
        # small star: the smaller neighbours and the node itself go to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        old, (e, new) = e, written(small)
        discard(old)
        discard(large)
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _same(a: DataFrame, b: DataFrame, names: list[str]):
    on = F.lit(True)
    for c in names:
        on = on & a[c].eqNullSafe(b[c])
    return on


def ranked(df: DataFrame, by: list[str], order: list[str], label: str = "ranked", groups: bool = True) -> DataFrame:
    """``df`` with three columns more: ``rank``, how many rows of the same ``by`` group come before in the order
    of the columns ``order``; ``size``, the group's rows; ``grp``, how many groups come before (nulls first; 0
    without ``groups``).

    Two passes, so that a group of any size is spread: rows are sorted over all partitions by range, a further
    column splits equal rows, and prefix sums run over one row a group and partition. ``label`` names the files.
    """
    keys = [F.col(c) for c in (*by, *order)]
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    rows = materialize(rows.withColumn("_part", F.spark_partition_id())
                       .withColumn("_at", F.monotonically_increasing_id()), label)
    runs = rows.groupBy(*by, "_part").agg(F.min("_at").alias("_base"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.sum("n").over(group.orderBy("_part")) - F.col("n")
    runs = materialize(runs.select(*by, "_part", (F.col("_base") - before).alias("_base"),
                                   F.sum("n").over(group).alias("size")), label)
    if by and groups:
        nth = ranked(runs.select(*by).distinct(), [], by, label).select(*by, F.col("rank").alias("grp"))
        runs = materialize(runs.join(nth, _same(runs, nth, by)).select(
            *[runs[c] for c in by], "_part", "_base", "size", "grp"), label)
    else:
        runs = runs.withColumn("grp", F.lit(0).cast("long"))
    out = rows.join(runs, _same(rows, runs, [*by, "_part"]))
    return out.select(*[rows[c] for c in df.columns], (rows["_at"] - runs["_base"]).alias("rank"), "size", "grp")


FREQUENT = 50_000             # keys of a broadcast side: each stands for at least that share of the rows


def join_by_frequency(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """Inner join on ``key``, which is unique and not null in ``right``; its column ``n`` counts the key's rows in ``left``.

    Keys with more than one in ``FREQUENT`` of the rows, so fewer than ``FREQUENT``, are broadcast; the other
    keys, none of them large, meet in a shuffle. ``right`` is read more than once and should be written.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    floor = total // FREQUENT
    often, rest = right.where(F.col(n) > floor), right.where(F.col(n) <= floor)
    out = left.join(F.broadcast(often), key)
    if floor and not rest.isEmpty():
        out = out.unionByName(left.join(F.broadcast(often.select(key)), key, "left_anti").join(rest.hint("merge"), key))
    return out
