"""ledgerloom — a Spark-native credit-portfolio lakehouse.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL API so that Catalyst and AQE choose the physical plan.
Tables are only touched in :mod:`ledgerloom.sinks` and
:mod:`ledgerloom.plans.medallion`.
"""

__version__ = "0.1.0"
