"""Analyst dashboards over the published tables of a :class:`ledgerloom.plans.medallion.Lake`.

Each is one of the DataFrame operators, applied to the gold or ops table it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import checks as C
from ledgerloom.operators import portfolio as P

#: name -> (layer, table, operator)
DASHBOARDS = {
    "executive": ("gold", "vw_executive_portfolio", lambda t: t.orderBy("snapshot_date")),
    "bucket_distribution": ("gold", "fact_credit_portfolio", P.bucket_distribution),
    "top_overdue_products": ("gold", "portfolio_kpis", P.top_overdue_products),
    "risk_by_state": ("gold", "portfolio_kpis", P.risk_by_state),
    "latest_quality": ("ops", "data_quality_results", C.latest_run),
}


def dashboard(spark: SparkSession, prefix: str, name: str) -> DataFrame:
    """One of the dashboards against the layer schemas ``<prefix>_gold`` / ``<prefix>_ops``."""
    layer, table, operator = DASHBOARDS[name]
    return operator(spark.table(f"{prefix}_{layer}.{table}"))
