"""The credit book over the driver's tables: every layer as a lazy DataFrame.

``CreditBook`` wires the operators in dependency order (bronze -> silver ->
gold) without writing tables; each registered query takes the layer it
needs. Layers are built on first use, so a query only plans what it reads.

With ``stage=True`` the layers that several consumers read (classified
contracts and payments, reconciled installments) are written once, as Parquet,
below the session's shared ``spark.checkpoint.dir``: later consumers read the
columns that they need instead of re-deriving them, and the
lineage is cut, so a lost executor does not recompute from the sources.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import portfolio as P
from ledgerloom.operators import quality as Q
from ledgerloom.operators import reconcile as R
from ledgerloom.session import scratch_dir
from ledgerloom.sources import testdata as TD


class CreditBook:
    def __init__(self, spark: SparkSession, sf_dir: str, today=TD.TODAY, as_of=None,
                 rank_strategy: str = "auto", stage: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.today = today
        self._as_of = as_of
        self.rank_strategy = rank_strategy
        self.stage = stage

    def _staged(self, df: DataFrame, layer: str) -> DataFrame:
        if not self.stage:
            return df
        path = scratch_dir(self.spark, f"book-{layer}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # bronze -------------------------------------------------------------
    @cached_property
    def customers_raw(self) -> DataFrame:
        return TD.customers_raw(self.spark, self.sf_dir)

    @cached_property
    def products_raw(self) -> DataFrame:
        return TD.products_raw(self.spark, self.sf_dir)

    @cached_property
    def contracts_raw(self) -> DataFrame:
        return TD.contracts_raw(self.spark, self.sf_dir)

    @cached_property
    def installments_raw(self) -> DataFrame:
        return TD.installments_raw(self.spark, self.sf_dir)

    @cached_property
    def payments_raw(self) -> DataFrame:
        return TD.payments_raw(self.spark, self.sf_dir)

    @cached_property
    def as_of(self):
        return self._as_of or R.as_of_date(self.installments_raw)

    # silver -------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return P.silver_customers(self.customers_raw)

    @cached_property
    def products(self) -> DataFrame:
        return P.silver_products(self.products_raw)

    @cached_property
    def contracts_classified(self) -> DataFrame:
        return self._staged(Q.classify_contracts(self.contracts_raw, self.customers, self.products,
                                                 today=self.today, rank_strategy=self.rank_strategy), "contracts")

    @cached_property
    def contracts(self) -> DataFrame:
        return Q.contracts_valid(self.contracts_classified)

    @cached_property
    def contracts_quarantine(self) -> DataFrame:
        return Q.contracts_quarantine(self.contracts_classified)

    @cached_property
    def payments_classified(self) -> DataFrame:
        return self._staged(Q.classify_payments(self.payments_raw, self.installments_raw,
                                                rank_strategy=self.rank_strategy), "payments")

    @cached_property
    def payments(self) -> DataFrame:
        return Q.payments_valid(self.payments_classified)

    @cached_property
    def payments_quarantine(self) -> DataFrame:
        return Q.payments_quarantine(self.payments_classified)

    @cached_property
    def installments_latest(self) -> DataFrame:
        return R.latest_installments(self.installments_raw, TD.INSTALLMENT_ORDER)

    @cached_property
    def installments(self) -> DataFrame:
        return self._staged(R.reconcile_installments(self.installments_latest, self.contracts,
                                                     self.payments, self.as_of), "installments")

    # gold ---------------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return P.dim_customer(self.customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return P.dim_product(self.products)

    @cached_property
    def position(self) -> DataFrame:
        return P.contract_position(self.installments)

    @cached_property
    def fact(self) -> DataFrame:
        """The contracts are joined once, to the installments of every contract:
        those without a trusted contract drop out there."""
        every = self.installments if self.stage else R.reconcile_installments(
            self.installments_latest, None, self.payments, self.as_of)
        return P.portfolio_fact(self.contracts, every)

    @cached_property
    def kpis(self) -> DataFrame:
        return P.portfolio_kpis(self.fact, self.dim_customer, self.dim_product)
