"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import posixpath
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The time zone matters: timestamps are rendered
# into change hashes, so a hash is only stable under one session zone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(master: str | None = None, app: str = "ledgerloom",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's required settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2)))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in SESSION_CONF.items():
        if k == "spark.sql.sources.partitionOverwriteMode":
            continue
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a session in one
    process (unit tests, ad-hoc local runs) gets a folder of its own; on a
    cluster that is an error, since no local folder is seen by all machines.
    """
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
            base = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return posixpath.join(base, "ledgerloom", *parts)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, uniquely named folder for one run of a write-path operator."""
    return shared_dir(spark, "runs", f"{label}-{uuid.uuid4().hex[:12]}")
