"""Lookup joins.

No side is broadcast by hint: the planner broadcasts a scan whose files are
small, and AQE turns a shuffle join into a broadcast join when the measured
side is small, and splits skewed partitions when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def lookup_join(left: DataFrame, right: DataFrame, cond: Column | str | list, how: str = "left") -> DataFrame:
    """``left`` joined to a lookup relation."""
    return left.join(right, cond, how)
