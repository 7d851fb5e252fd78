"""Hash-gated synchronisation of a target with a source.

Semantics of ``MERGE ... WHEN MATCHED AND t.hash <> s.hash THEN UPDATE SET *
WHEN NOT MATCHED THEN INSERT * WHEN NOT MATCHED BY SOURCE THEN DELETE``,
expressed as one full outer join on the key:

* INSERT: key only in the source (a NULL source key never matches -> INSERT)
* DELETE: key only in the target
* UPDATE: both, and the hashes differ (NULL hash on either side -> KEEP)
* KEEP:   both, same hash -- the *target* row is kept, so its processing
  timestamp does not move.

The join shuffles both sides by key once; the plan is a DataFrame, so the
new state and the action counts come from the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE, KEEP = "INSERT", "UPDATE", "DELETE", "KEEP"


class MergeCardinalityError(ValueError):
    """Several source rows match the same target row."""


def sync_merge_plan(target: DataFrame, source: DataFrame, key: str,
                    hash_col: str = "record_hash") -> DataFrame:
    """Rows ``(_action, <source columns>)``: the row each action writes.

    DELETE rows carry the target row (what is removed); every other action
    carries the row that is in the new state.
    """
    cols = source.columns
    t = target.select(F.col(key).alias("_tk"), F.col(hash_col).alias("_th"),
                      F.struct(*[F.col(c) for c in cols]).alias("_t"))
    s = source.select(F.col(key).alias("_sk"), F.col(hash_col).alias("_sh"),
                      F.struct(*[F.col(c) for c in cols]).alias("_s"))
    j = t.join(s, F.col("_tk") == F.col("_sk"), "full_outer")
    action = (F.when(F.col("_t").isNull(), F.lit(INSERT))
               .when(F.col("_s").isNull(), F.lit(DELETE))
               .when(F.coalesce(F.col("_th") != F.col("_sh"), F.lit(False)), F.lit(UPDATE))
               .otherwise(F.lit(KEEP)))
    row = F.when(action.isin(INSERT, UPDATE), F.col("_s")).otherwise(F.col("_t"))
    return j.select(action.alias("_action"), row.alias("_row"), F.col("_tk")).select(
        "_action", "_tk", *[F.col(f"_row.{c}").alias(c) for c in cols])


def check_cardinality(plan: DataFrame) -> None:
    """Raise if one target key is matched by more than one source row."""
    dup = (plan.where(F.col("_action").isin(UPDATE, KEEP))
               .groupBy("_tk").count().where(F.col("count") > 1).limit(1).count())
    if dup:
        raise MergeCardinalityError("several source rows match one target row")


def merged_state(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("_action") != DELETE).drop("_action", "_tk")


def action_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("rows"))
