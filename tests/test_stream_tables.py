"""Exactly-once loads into declared tables, and CSV files of different column orders."""
import gzip
import os
import posixpath

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sinks import tables as TB
from ledgerloom.streaming import tables as ST

CSV = T.StructType([T.StructField("id", T.LongType()), T.StructField("customer", T.LongType()),
                    T.StructField("amt", T.DecimalType(18, 2))])
JSON = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


@pytest.fixture()
def made(spark, tmp_root, request):
    """``(landing, table, log, load)``: a declared sink with its log, and a function that loads new files."""
    tag = f"st_{abs(hash(request.node.name)) % 10**9}"
    landing, table, log = posixpath.join(tmp_root, "landing"), f"{tag}_sink", f"{tag}_log"

    def load(fmt="csv", schema=CSV, **kw):
        rescue = {"rescue": True, "transform": lambda df: df.select(*schema.fieldNames())} if fmt == "json" else {
            "transform": lambda df: df.select(*schema.fieldNames(), *[f.name for f in kw.get("partition_cols") or []])}
        parts = [f.name for f in kw.get("partition_cols") or []]
        whole = T.StructType([*schema.fields, *(kw.get("partition_cols") or [])])
        ST.declare_sink(spark, table, whole, partition_by=parts, location=posixpath.join(tmp_root, "table"))
        ST.declare_sink(spark, log, ST.LOAD_LOG, location=posixpath.join(tmp_root, "log"))
        return ST.load_files(spark, "orders", landing, fmt, schema, table, posixpath.join(tmp_root, "ck"), log=log, **{**rescue, **kw})

    yield landing, table, log, load
    for t in (table, log):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_each_file_loads_by_its_own_header(spark, made):
    landing, table, log, load = made
    write(landing, "a.csv", "id,customer,amt\n1,2,3\n")
    write(landing, "b.csv", "customer,id,amt\n7,8,9.50\n70,80,90\n")
    write(landing, "c.csv", "amt,customer,id\n")
    write(landing, "d.csv", "")
    with gzip.open(os.path.join(landing, "e.csv.gz"), "wt") as f:
        f.write("amt,id,customer\n5,10,20\n")
    assert load()["rows"] == 4 and load()["rows"] == 0
    write(landing, "f.csv", 'amt,"customer",id\n1,200,100\n')
    assert load()["rows"] == 1
    got = {r.id: (r.customer, float(r.amt)) for r in spark.table(table).collect()}
    assert got == {1: (2, 3.0), 8: (7, 9.5), 80: (70, 90.0), 10: (20, 5.0), 100: (200, 1.0)}
    assert {r.load_id: r.rows_added for r in spark.table(log).collect()} == {"orders-0000000000": 4, "orders-0000000001": 1}


@pytest.mark.parametrize("text", ["id,amt\n1,5\n", "id,customer,amt,extra\n1,2,3,4\n", "id,customer,amt\n1,2\n",
                                  "id,customer,amt\n1,2,3,4\n", "id,customer,amt\n1,x,3\n"])
def test_a_bad_file_fails_its_batch_and_loads_once_mended(spark, made, text):
    landing, table, log, load = made
    write(landing, "a.csv", "customer,id,amt\n7,8,9\n")
    write(landing, "b.csv", text)
    with pytest.raises(Exception):
        load()
    assert spark.table(table).count() == 0 and spark.table(log).count() == 0
    write(landing, "b.csv", "amt,id,customer\n5,1,2\n")
    assert load()["rows"] == 2 and sorted(r.id for r in spark.table(table).collect()) == [1, 8]


def test_partition_columns_come_from_the_folders(spark, made):
    landing, table, _, load = made
    part = T.StructType([T.StructField("batch_date", T.DateType())])
    write(f"{landing}/batch_date=2000-01-01", "a.csv", "id,customer,amt\n1,2,3\n")
    write(f"{landing}/batch_date=2000-01-02", "a.csv", "amt,customer,id\n3,2,1\n")
    assert load(partition_cols=part)["rows"] == 2
    assert sorted((str(r.batch_date), r.id, r.customer) for r in spark.table(table).collect()) == [
        ("2000-01-01", 1, 2), ("2000-01-02", 1, 2)]


def test_a_batch_that_fails_after_its_write_adds_its_rows_once(spark, made):
    landing, table, log, load = made
    for i in range(6):
        write(landing, f"{i}.json", f'{{"id":{i}}}\n{{"id":{i}}}\n')

    def lost(number):
        if number == 2:
            raise RuntimeError("lost before the commit")

    with pytest.raises(Exception):
        load("json", JSON, max_files_per_trigger=1, written=lost)
    assert spark.table(table).count() == 6           # three batches are in the table, two are committed
    again = load("json", JSON, max_files_per_trigger=1)
    assert min(again["batches"]) == 2 and again["rows"] == 8
    assert spark.table(table).groupBy("id").count().where("count <> 2").count() == 0
    assert spark.table(table).count() == 12
    assert spark.table(log).agg(F.sum("rows_added"), F.count("*")).first()[:] == (12, 6)


def test_counts_are_exact_over_many_batches_without_reading_the_table(spark, made, monkeypatch):
    landing, table, log, load = made
    for i in range(150):
        write(landing, f"{i}.json", f'{{"id":{i}}}\n\n')      # a blank line is no row

    def refuse(*args):
        raise AssertionError("a load must not count by an action of its own")

    for action in ("count", "collect", "first", "toPandas"):
        monkeypatch.setattr(type(spark.range(1)), action, refuse)
    out = load("json", JSON, max_files_per_trigger=1)
    monkeypatch.undo()
    assert out["rows"] == 150 and len(out["batches"]) == 150
    assert [p.batchId for p in out["history"]] == list(range(150))       # every batch's report, not the last hundred
    assert spark.table(log).agg(F.sum("rows_added")).first()[0] == 150 == spark.table(table).count()


def test_reset_takes_the_rows_out(spark, made, tmp_root):
    landing, table, _, load = made
    write(landing, "a.csv", "id,customer,amt\n1,2,3\n")
    assert load()["rows"] == 1
    ST.reset_load(spark, "orders", table, posixpath.join(tmp_root, "ck"))
    assert spark.table(table).count() == 0 and load()["rows"] == 1 == spark.table(table).count()


def test_table_reader_sees_declared_schema(spark, made):
    landing, table, _, load = made
    write(landing, "a.json", '{"id":1,"note":"x"}\n')
    load("json", JSON)
    assert spark.table(table).columns == ["id", "note", "load_id"]
    assert TB.table_properties(spark, table) is not None
