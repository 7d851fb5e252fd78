import datetime as dt
import os
import posixpath
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import files as FS
from ledgerloom.streaming import ingest as ST

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DecimalType(18, 2)),
                       T.StructField("d", T.DateType()), T.StructField("note", T.StringType())])


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_typed_csv_strict_and_lenient(spark, tmp_root):
    p = posixpath.join(tmp_root, "csv", "batch_date=2000-01-01")
    write(p, "a.csv", "id,amt,d,note\n1,10.50,2000-01-02,x\n2,oops,2000-01-03,y\n")
    lenient = FS.read_typed_csv(spark, posixpath.dirname(p), SCHEMA, strict=False, metadata=True)
    rows = {r["id"]: r for r in lenient.collect()}
    assert rows[1]["amt"] == Decimal("10.50") and rows[1]["_rescued_data"] is None
    assert rows[2]["amt"] is None and rows[2]["_rescued_data"] == '{"amt":"oops"}'
    assert rows[1]["batch_date"] == dt.date(2000, 1, 1) and rows[1]["source_file_name"] == "a.csv"
    with pytest.raises(Exception):
        FS.read_typed_csv(spark, posixpath.dirname(p), SCHEMA, strict=True).collect()


def test_csv_unexpected_column_is_an_error(spark, tmp_root):
    p = posixpath.join(tmp_root, "csv2")
    write(p, "a.csv", "id,amt,d,surprise\n1,1.00,2000-01-01,z\n")
    with pytest.raises(Exception):
        FS.read_typed_csv(spark, p, SCHEMA).collect()


def test_csv_files_of_different_column_orders(spark, tmp_root):
    root = posixpath.join(tmp_root, "csv3")
    write(posixpath.join(root, "batch_date=2000-01-01"), "a.csv", "id,amt,d,note\n1,1.00,2000-01-01,z\n")
    write(posixpath.join(root, "batch_date=2000-01-02"), "b.csv", "note,d,amt,id\ny,2000-01-02,oops,2\n")
    one = FS.read_typed_csv(spark, root, SCHEMA, strict=False, mixed=True)
    rows = {r["id"]: r for r in one.collect()}
    assert rows[1]["amt"] == Decimal("1.00") and rows[1]["batch_date"] == dt.date(2000, 1, 1)
    assert (rows[2]["note"], rows[2]["amt"], rows[2]["_rescued_data"], rows[2]["source_file_name"]) == ("y", None, '{"amt":"oops"}', "b.csv")
    same = FS.read_typed_csv(spark, posixpath.join(root, "batch_date=2000-01-01"), SCHEMA, strict=False)
    assert set(one.columns) == {*same.columns, "batch_date"}
    with pytest.raises(Exception):
        FS.read_typed_csv(spark, root, SCHEMA, strict=True, mixed=True).collect()
    write(posixpath.join(root, "batch_date=2000-01-03"), "c.csv", "id,amt,d,other\n1,1.00,2000-01-01,z\n")
    with pytest.raises(ValueError):
        FS.read_typed_csv(spark, root, SCHEMA, mixed=True)


def test_permissive_json_keeps_corrupt_lines(spark, tmp_root):
    p = posixpath.join(tmp_root, "json")
    write(p, "a.json", '{"id": 1, "amt": 2.5, "d": "2000-01-01"}\n{"id": 2, "amt": \nnot json\n')
    df = FS.read_permissive_json(spark, p, SCHEMA).cache()
    assert df.where(F.col("corrupt_record").isNotNull()).count() == 2
    assert df.where(F.col("id") == 1).select("amt").first()[0] == Decimal("2.50")


def test_parse_with_rescue_cases(spark):
    lines = spark.createDataFrame([
        ('{"id":1,"amt":12.30,"d":"2000-01-02","note":"a"}',),
        ('{"id":2,"amt":"unknown","extra":"x"}',),
        ('{"id":3,"amt":null,"nested":{"k":1}}',),
        ('broken',),
        ('',), ('   ',),
    ], "value string")
    out = {r["id"]: r for r in FS.parse_with_rescue(lines, SCHEMA).collect()}
    assert out[1]["_rescued_data"] is None and out[1]["amt"] == Decimal("12.30")
    assert out[2]["_rescued_data"] == '{"amt":"unknown","extra":"x"}'
    assert out[3]["_rescued_data"] == '{"nested":"{\\"k\\":1}"}'
    assert out[None]["_rescued_data"] == "broken"
    assert FS.parse_with_rescue(lines, SCHEMA).count() == 4   # blank lines are skipped


def test_incremental_load_exactly_once_and_old_files(spark, tmp_root):
    landing, sink, ck = (posixpath.join(tmp_root, x) for x in ("land", "sink", "ck"))
    part = T.StructType([T.StructField("event_date", T.DateType())])
    write(posixpath.join(landing, "event_date=2000-01-01"), "a.json", '{"id":1,"amt":1.00}\n{"id":1,"amt":1.00}\n')
    n1 = ST.load_new_files(spark, landing, "json", SCHEMA, sink, ck, partition_cols=part, rescue=True)
    n2 = ST.load_new_files(spark, landing, "json", SCHEMA, sink, ck, partition_cols=part, rescue=True)
    p2 = posixpath.join(landing, "event_date=2000-01-02")
    write(p2, "b.json", '{"id":2,"amt":2.00,"new_field":true}\n')
    old = 1_000_000_000  # a new file with a 2001 modification time is still loaded
    os.utime(os.path.join(p2, "b.json"), (old, old))
    n3 = ST.load_new_files(spark, landing, "json", SCHEMA, sink, ck, partition_cols=part, rescue=True)
    assert (n1, n2, n3) == (2, 0, 1)   # a duplicate inside a file is kept
    out = spark.read.parquet(sink)
    assert out.count() == 3
    r = out.where(F.col("id") == 2).first()
    assert r["_rescued_data"] == '{"new_field":"true"}' and r["event_date"] == dt.date(2000, 1, 2)


def test_batch_and_stream_parse_agree(spark, tmp_root):
    landing = posixpath.join(tmp_root, "bs")
    write(landing, "a.json", '{"id":1,"amt":"x"}\n{"id":2,"amt":3}\nnope\n')
    batch = FS.parse_with_rescue(spark.read.text(landing), SCHEMA)
    sink, ck = posixpath.join(tmp_root, "bs_sink"), posixpath.join(tmp_root, "bs_ck")
    ST.load_new_files(spark, landing, "json", SCHEMA, sink, ck, rescue=True)
    cols = [f.name for f in SCHEMA.fields] + ["_rescued_data"]
    assert sorted(map(tuple, batch.select(*cols).collect()), key=str) == \
        sorted(map(tuple, spark.read.parquet(sink).select(*cols).collect()), key=str)


def test_preview_and_inferred_stream(spark, tmp_root):
    landing = posixpath.join(tmp_root, "inf", "day=2000-01-01")
    write(landing, "a.json", '{"id": 1, "x": 1.5}\n{"id": 2, "x": 2.5}\n{"id": 3, "x": null}\n')
    root = posixpath.dirname(landing)
    assert FS.preview(spark, root, "json", n=2).count() == 2
    schema = ST.infer_schema(spark, root)
    assert dict((f.name, f.dataType.simpleString()) for f in schema.fields) == \
        {"id": "bigint", "x": "double", "day": "date"}
    sink, ck = posixpath.join(tmp_root, "inf_sink"), posixpath.join(tmp_root, "inf_ck")
    assert ST.drain(ST.inferred_file_stream(spark, root), sink, ck) == 3
    assert spark.read.parquet(sink).where(F.col("day") == dt.date(2000, 1, 1)).count() == 3


def test_progress_report(spark, tmp_root):
    landing = posixpath.join(tmp_root, "pr")
    write(landing, "a.json", '{"id":1}\n{"id":2}\n')
    df = ST.file_stream(spark, landing, "json", SCHEMA, rescue=True)
    out = ST.drain_with_progress(df, posixpath.join(tmp_root, "pr_sink"), posixpath.join(tmp_root, "pr_ck"),
                                 query_name="progress_probe")
    assert out["rows"] == 2 and out["last_progress"]["name"] == "progress_probe"
    again = ST.drain_with_progress(ST.file_stream(spark, landing, "json", SCHEMA, rescue=True),
                                   posixpath.join(tmp_root, "pr_sink"), posixpath.join(tmp_root, "pr_ck"))
    assert again["rows"] == 0 and again["last_progress"]["numInputRows"] == 0
    assert ST.active_streams(spark) == []


CSV = T.StructType([T.StructField("id", T.LongType()), T.StructField("customer", T.LongType()),
                    T.StructField("amt", T.DecimalType(18, 2))])


def test_streamed_csv_loads_by_name(spark, tmp_root):
    landing, sink, ck = (posixpath.join(tmp_root, x) for x in ("csv", "csv_sink", "csv_ck"))
    write(landing, "a.csv", "customer,id,amt\n77,1,5.00\n78,2,6.50\n")
    assert ST.load_new_files(spark, landing, "csv", CSV, sink, ck) == 2
    assert sorted((r["id"], r["customer"]) for r in spark.read.parquet(sink).collect()) == [(1, 77), (2, 78)]


@pytest.mark.parametrize("text", ["id,amt\n1,5\n", "id,customer,amt,extra\n1,2,3,4\n", "id,customer,amt\n1,2\n",
                                  "id,customer,amt\n1,2,3,4\n", "id,customer,amt\n1,x,3\n"])
def test_streamed_csv_fails_on_bad_files_with_nothing_written(spark, tmp_root, text):
    landing, sink, ck = (posixpath.join(tmp_root, x) for x in ("bad", "bad_sink", "bad_ck"))
    write(landing, "a.csv", text)
    with pytest.raises(Exception):
        ST.load_new_files(spark, landing, "csv", CSV, sink, ck)
    assert ST._rows(spark, sink, CSV) == 0


def test_streamed_csv_rejects_mixed_headers(spark, tmp_root):
    landing, sink, ck = (posixpath.join(tmp_root, x) for x in ("mix", "mix_sink", "mix_ck"))
    write(landing, "a.csv", "id,customer,amt\n1,2,3\n")
    write(landing, "b.csv", "customer,id,amt\n7,8,9\n")
    with pytest.raises(Exception):
        ST.load_new_files(spark, landing, "csv", CSV, sink, ck)


def test_row_counts_are_exact_over_many_batches(spark, tmp_root):
    landing, sink, ck = (posixpath.join(tmp_root, x) for x in ("many", "many_sink", "many_ck"))
    for i in range(110):
        write(landing, f"{i}.json", f'{{"id":{i}}}\n\n')      # a blank line is no row
    assert ST.load_new_files(spark, landing, "json", SCHEMA, sink, ck, rescue=True, max_files_per_trigger=1) == 110
    assert ST.load_new_files(spark, landing, "json", SCHEMA, sink, ck, rescue=True) == 0
    ST.reset_stream(spark, sink, ck)
    assert ST.load_new_files(spark, landing, "json", SCHEMA, sink, ck, rescue=True) == 110


def test_rescue_keeps_digits_and_repeated_keys(spark):
    lines = spark.createDataFrame([('{"id":1,"amt":"12.345"}',), ('{"id":2,"amt":1,"amt":2}',), ('{"id":3,"amt":"12.340"}',)], "value string")
    out = {r["id"]: r for r in FS.parse_with_rescue(lines, SCHEMA).collect()}
    assert out[1]["amt"] is None and out[1]["_rescued_data"] == '{"amt":"12.345"}'
    assert out[2]["_rescued_data"] == '{"id":2,"amt":1,"amt":2}'
    assert out[3]["_rescued_data"] is None


def test_landing_is_written_once_unless_forced(spark, tmp_root):
    path = posixpath.join(tmp_root, "once")
    assert FS.write_landing(spark.range(3), path, "parquet", if_present="skip")
    assert not FS.write_landing(spark.range(5), path, "parquet", if_present="skip")
    assert spark.read.parquet(path).count() == 3
    assert FS.write_landing(spark.range(5), path, "parquet") and spark.read.parquet(path).count() == 5
