"""Latest-row-per-key and duplicate ranking.

All orderings here are *descending, NULLS LAST* (the only direction the
product uses): the newest snapshot / update / file wins.

Scale notes
-----------
* ``latest_per_key`` is ``row_number() = 1`` over a total order. Spark plans it
  with a *partial* ``WindowGroupLimit`` before the exchange, so a key that holds
  a third of all rows is cut to one row per map task before the shuffle
  (measured faster than a ``max_by`` struct aggregate, which runs sort-based).
* ``rank_duplicates`` must keep *every* row with its rank. The default
  ``strategy="auto"`` finds hot keys from a seeded sample of the key columns
  (about 1,000 sampled rows per ``hot_rows`` rows; no full count, no extra
  shuffle of the data). Hot keys are ranked through a global range-partitioned
  sort: the range partitioner splits a hot key over many tasks, each task
  numbers its own slice, and a small per-(key, slice) count table supplies the
  offset of the slices before it, so no task ever holds a whole hot group.
  All other keys take the plain ``row_number()`` window (one shuffle). Both
  paths sort by one shared list of columns, the order columns, the tie hash and
  then every other orderable column, so the sample decides speed alone.
  ``strategy="window"`` / ``"sorted"`` force one path (tests cross-check them).

  Why a range sort and not "window per (key, order bucket)": a key with a
  third of 100 TB needs ~10^5 buckets, and assigning a row to a bucket needs
  a binary search over the boundaries, which only the range partitioner does
  natively; a per-row linear scan over boundary arrays would cost ~10^5
  comparisons per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import as_col, record_hash
from ledgerloom.session import shared_dir


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   where: Column | None = None) -> DataFrame:
    """One row per key: the greatest by ``order`` (descending, NULLS LAST).

    ``where`` filters *before* ranking, so the latest *valid* version wins.
    Remaining ties are broken by the row's own (orderable) values, which makes
    the choice deterministic. NULL keys form one group, as in ``PARTITION BY``.
    """
    if where is not None:
        df = df.where(where)
    keys = list(keys)
    ties = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    w = Window.partitionBy(*keys).orderBy(*[as_col(c).desc_nulls_last() for c in order],
                                          *[F.col(c).desc_nulls_last() for c in ties])
    return df.withColumn("_latest", F.row_number().over(w)).where(F.col("_latest") == 1).drop("_latest")


def _tie_column(tie_cols: Sequence[str] | None) -> list[Column]:
    if not tie_cols:
        return []
    return [record_hash(*tie_cols)]


HOT_KEY_ROWS = 1_000_000      # floor: a key needs at least this many rows to be hot
HOT_KEY_SHARE = 4.0           # ... and at least this many times the rows of an average shuffle partition


def rank_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    tie_cols: Sequence[str] | None = None, out: str = "duplicate_rank",
                    strategy: str = "auto", hot_rows: int = HOT_KEY_ROWS,
                    hot_share: float = HOT_KEY_SHARE) -> DataFrame:
    """Add ``out`` = 1-based position (BIGINT) of each row within its key (rows are kept).

    Order: ``order`` descending NULLS LAST, then the SHA-256 of ``tie_cols``
    (descending), then every other orderable column (descending), so that only
    rows equal in all of them are interchangeable.

    A key is hot when it holds more than ``hot_rows`` rows and more than
    ``hot_share`` times the rows of an average shuffle partition (estimated
    from the same sample).
    """
    keys = list(keys)
    order_cols = [as_col(c) for c in order] + _tie_column(tie_cols)
    order_cols += [F.col(f.name) for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    if strategy == "window":
        return _rank_by_window(df, keys, order_cols, out)
    if strategy == "sorted":
        return _rank_by_global_sort(df, keys, order_cols, out)
    if strategy != "auto":
        raise ValueError(f"unknown strategy {strategy!r}")
    hot = _hot_keys(df, keys, hot_rows, hot_share)
    if hot is None:
        return _rank_by_window(df, keys, order_cols, out)
    hot = F.broadcast(hot)   # fewer keys than shuffle partitions: each holds several partitions' worth of rows
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hk_{k}")) for k in keys])
    cold = df.join(hot, cond, "left_anti")
    heavy = df.join(hot, cond, "left_semi")
    return (_rank_by_window(cold, keys, order_cols, out)
            .unionByName(_rank_by_global_sort(heavy, keys, order_cols, out)))


def _hot_keys(df: DataFrame, keys: list[str], hot_rows: int, hot_share: float = HOT_KEY_SHARE,
              seed: int = 17) -> DataFrame | None:
    """Keys estimated to be hot, from one aggregate over a seeded sample of the key columns.

    The fraction keeps ~1,000 sampled rows per ``hot_rows`` rows. The sample's
    total, which estimates the row count N, is observed in the same pass. A
    returned key holds over half of ``hot_share * N / shuffle partitions`` rows,
    so there are at most ``2 / hot_share`` times as many as shuffle partitions.
    """
    frac = min(1.0, 1000.0 / max(hot_rows, 1))
    cutoff = max(1, int(hot_rows * frac / 2))
    sampled = df.select(*keys) if frac >= 1.0 else df.select(*keys).sample(fraction=frac, seed=seed)
    seen = Observation()
    counted = sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("total"))
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # of the sample's keys only those above the floor reach the driver: 500 sampled rows each at least
    rows = counted.where(F.col("_n") >= cutoff).collect()
    n_est = (seen.get.get("total") or 0) / frac
    threshold = max(float(hot_rows), hot_share * n_est / partitions)
    hot = [r for r in rows if r["_n"] / frac > threshold / 2]
    if not hot:
        return None
    schema = T.StructType([T.StructField(f"_hk_{k}", df.schema[k].dataType) for k in keys])
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)


def _rank_by_window(df: DataFrame, keys: list[str], order_cols: list[Column], out: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order_cols])
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def _rank_by_global_sort(df: DataFrame, keys: list[str], order_cols: list[Column],
                         out: str) -> DataFrame:
    base_cols = df.columns
    okeys = [f"_rk{i}" for i in range(len(order_cols))]
    s = df.withColumns(dict(zip(okeys, order_cols)))
    s = s.orderBy(*[F.col(k).asc_nulls_first() for k in keys],
                  *[F.col(k).desc_nulls_last() for k in okeys])
    s = s.withColumn("_gid", F.monotonically_increasing_id())
    # Fix the ids (and cut the lineage) before they are read twice. The
    # checkpoint goes to the session's spark.checkpoint.dir (set only if unset).
    shared_dir(df.sparkSession)
    s = s.checkpoint(eager=True)
    s = s.withColumn("_slice", F.shiftright("_gid", 33))
    seg = (s.groupBy(*keys, "_slice")
             .agg(F.min("_gid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    seg = seg.select(*[F.col(k).alias(f"_sk_{k}") for k in keys],
                     F.col("_slice").alias("_sk_slice"), "_first", "_before")
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_sk_{k}")) for k in keys]
                  + [F.col("_slice") == F.col("_sk_slice")])
    ranked = s.join(seg, cond, "inner")
    rank = (F.col("_before") + (F.col("_gid") - F.col("_first")) + F.lit(1)).cast("bigint")
    return ranked.select(*[F.col(c) for c in base_cols], rank.alias(out))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (``HAVING COUNT(*) > 1``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
              .where(F.col("row_count") > 1))
