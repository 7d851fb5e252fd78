"""What the queries write on their way: landing files compressed, staged layers in columns."""
import os

from pyspark.sql import functions as F

from ledgerloom.plans import queries_io as Q
from ledgerloom.plans.book import CreditBook


def _tables(spark, root):
    """A lineitem table of 3,000 rows."""
    n = F.col("id")
    spark.range(3000).select(
        n.alias("l_orderkey"), (n % 7 + 1).cast("int").alias("l_linenumber"), (n % 200).alias("l_partkey"), (n % 10).alias("l_suppkey"),
        (n % 50 + 1).cast("double").alias("l_quantity"), (n * 1.25).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
        (n % 9 / 100).alias("l_tax"), F.when(n % 5 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.expr("timestamp'1997-01-01' + make_interval(0, 0, 0, cast(id % 300 as int))").alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")
    return root


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if not f.startswith((".", "_")))


def test_payment_deliveries_are_compressed(spark, tmp_root):
    lines = Q._payment_lines(spark, _tables(spark, tmp_root))
    landing = f"{tmp_root}/landing"
    Q._deliver_payments(lines, landing)
    text = lines.agg(F.sum(F.length("value") + 1)).first()[0]
    assert _bytes(landing) < text / 4
    back = spark.read.text(landing).select("value")
    assert back.count() == 3000 and back.exceptAll(lines.select("value")).isEmpty()


def test_staged_layers_are_written_as_columns(spark, tmp_root):
    sf = _tables(spark, tmp_root)
    plain, staged = (CreditBook(spark, sf, stage=s).payments_classified for s in (False, True))
    files = staged.inputFiles()
    assert files and all("book-payments" in f and f.endswith(".parquet") for f in files)
    assert staged.schema == plain.schema or staged.dtypes == plain.dtypes
    assert staged.count() == 3000 and staged.exceptAll(plain).isEmpty()
