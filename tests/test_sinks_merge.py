import datetime as dt
import posixpath

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import merge as M
from ledgerloom.sinks import tables as TB

SCHEMA = "k int, v string, h string"


def test_sync_merge_plan_actions(spark):
    target = spark.createDataFrame([(1, "a", "h1"), (2, "b", "h2"), (3, "c", "h3"), (4, "d", None),
                                    (None, "t", "x")], SCHEMA)
    source = spark.createDataFrame([(1, "a", "h1"), (2, "B", "h2x"), (4, "D", "h4"), (5, "e", "h5"),
                                    (None, "s", "y")], SCHEMA)
    plan = M.sync_merge_plan(target, source, "k", "h")
    acts = {(r["_action"], r["k"], r["v"]) for r in plan.collect()}
    assert ("KEEP", 1, "a") in acts and ("UPDATE", 2, "B") in acts and ("DELETE", 3, "c") in acts
    assert ("KEEP", 4, "d") in acts          # NULL hash on one side -> KEEP (target row stays)
    assert ("INSERT", 5, "e") in acts and ("INSERT", None, "s") in acts and ("DELETE", None, "t") in acts
    state = {(r["k"], r["v"]) for r in M.merged_state(plan).collect()}
    assert state == {(1, "a"), (2, "B"), (4, "d"), (5, "e"), (None, "s")}


def test_apply_sync_merge_twice_is_noop(spark, tmp_root):
    name = "merge_t_" + posixpath.basename(tmp_root).replace("-", "_")
    TB.ensure_table(spark, name, T._parse_datatype_string(SCHEMA), "t", {"layer": "silver"},
                    location=posixpath.join(tmp_root, "t"))
    spark.createDataFrame([(1, "a", "h1"), (2, "b", "h2")], SCHEMA).write.insertInto(name)
    src = spark.createDataFrame([(1, "a", "h1"), (3, "c", "h3")], SCHEMA)
    assert TB.apply_sync_merge(spark, name, src, "k", "h") == {"INSERT": 1, "UPDATE": 0, "DELETE": 1, "KEEP": 1}
    assert TB.apply_sync_merge(spark, name, src, "k", "h") == {"INSERT": 0, "UPDATE": 0, "DELETE": 0, "KEEP": 2}
    assert sorted(r["k"] for r in spark.table(name).collect()) == [1, 3]


def test_merge_cardinality_error(spark):
    target = spark.createDataFrame([(1, "a", "h1")], SCHEMA)
    source = spark.createDataFrame([(1, "a", "h1"), (1, "b", "h2")], SCHEMA)
    with pytest.raises(M.MergeCardinalityError):
        M.check_cardinality(M.sync_merge_plan(target, source, "k", "h"))


SNAP = T.StructType([T.StructField("id", T.StringType()), T.StructField("amt", T.IntegerType()),
                     T.StructField("snapshot_date", T.DateType())])


def test_replace_snapshot_keeps_other_dates(spark, tmp_root):
    name = "snap_t_" + posixpath.basename(tmp_root).replace("-", "_")
    TB.ensure_table(spark, name, SNAP, "snapshots", partition_by=["snapshot_date"],
                    location=posixpath.join(tmp_root, "s"))
    d1, d2 = dt.date(2000, 1, 1), dt.date(2000, 2, 1)
    TB.replace_snapshot(spark.createDataFrame([("a", 1, d1), ("b", 2, d1)], SNAP), name, "snapshot_date", d1)
    TB.replace_snapshot(spark.createDataFrame([("a", 10, d2)], SNAP), name, "snapshot_date", d2)
    TB.replace_snapshot(spark.createDataFrame([("c", 30, d2)], SNAP), name, "snapshot_date", d2)
    got = sorted((r["id"], r["amt"], r["snapshot_date"]) for r in spark.table(name).collect())
    assert got == [("a", 1, d1), ("b", 2, d1), ("c", 30, d2)]
    with pytest.raises(ValueError):
        TB.replace_snapshot(spark.createDataFrame([("x", 1, d1)], SNAP), name, "snapshot_date", d2)
    TB.replace_snapshot(spark.createDataFrame([], SNAP), name, "snapshot_date", d2)  # empty: slice removed
    assert sorted(r["id"] for r in spark.table(name).collect()) == ["a", "b"]


def test_schema_policy(spark, tmp_root):
    name = "pol_t_" + posixpath.basename(tmp_root).replace("-", "_")
    TB.ensure_table(spark, name, SNAP, "p", location=posixpath.join(tmp_root, "p"))
    wider = T.StructType(SNAP.fields + [T.StructField("extra", T.StringType())])
    with pytest.raises(ValueError):
        TB.ensure_table(spark, name, wider, "p")
    TB.ensure_table(spark, name, wider, "p", allow_new_columns=True)
    assert "extra" in spark.table(name).columns


def test_bucketed_merge_rewrites_only_changed_buckets(spark, tmp_root):
    import glob
    import os
    name = "bmerge_" + posixpath.basename(tmp_root).replace("-", "_")
    loc = posixpath.join(tmp_root, "bt")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType()),
                           T.StructField("h", T.StringType()), T.StructField("_bucket", T.IntegerType())])
    TB.ensure_table(spark, name, schema, "bucketed", partition_by=["_bucket"], location=loc)
    rows = [(i, f"v{i}", f"h{i}") for i in range(200)]
    first = spark.createDataFrame(rows, SCHEMA)
    assert TB.apply_sync_merge(spark, name, first, "k", "h", "_bucket", 8)["INSERT"] == 200
    before = {p: os.path.getmtime(p) for p in glob.glob(loc + "/_bucket=*/*.parquet")}
    changed_key = 7
    second = spark.createDataFrame([(k, v if k != changed_key else "new", h if k != changed_key else "hx")
                                    for k, v, h in rows], SCHEMA)
    counts = TB.apply_sync_merge(spark, name, second, "k", "h", "_bucket", 8)
    assert counts == {"INSERT": 0, "UPDATE": 1, "DELETE": 0, "KEEP": 199}
    after = {p: os.path.getmtime(p) for p in glob.glob(loc + "/_bucket=*/*.parquet")}
    bucket = spark.createDataFrame([(changed_key,)], "k int").select(TB.merge_bucket("k", 8)).first()[0]
    untouched = [p for p in before if f"_bucket={bucket}/" not in p]
    assert untouched and all(p in after and after[p] == before[p] for p in untouched)
    got = {(r["k"], r["v"]) for r in spark.table(name).collect()}
    assert got == {(k, v if k != changed_key else "new") for k, v, _ in rows}
    # deleting every row of a bucket drops the partition
    third = second.where(TB.merge_bucket("k", 8) != bucket)
    c3 = TB.apply_sync_merge(spark, name, third, "k", "h", "_bucket", 8)
    assert c3["DELETE"] > 0 and spark.table(name).where(F.col("_bucket") == bucket).count() == 0
    assert not glob.glob(f"{loc}/_bucket={bucket}/*.parquet")      # a reader of the folder sees no deleted rows


def test_namespaces_comments_properties_and_describe(spark, tmp_root):
    ns = "lln_" + posixpath.basename(tmp_root).replace("-", "_")
    TB.ensure_namespaces(spark, {ns: "bronze layer"}, location=tmp_root)
    assert spark.catalog.databaseExists(ns)
    name = f"{ns}.payments_raw"
    TB.ensure_table(spark, name, SNAP, "payments", {"data_layer": "bronze"}, location=posixpath.join(tmp_root, "pr"))
    TB.set_table_properties(spark, name, comment="payment events",
                            props={"ingestion_pattern": "stream_available_now"})
    props = TB.table_properties(spark, name)
    assert props["data_layer"] == "bronze" and props["ingestion_pattern"] == "stream_available_now"
    d = {r["col_name"]: r["data_type"] for r in TB.describe_table(spark, name).collect()}
    assert d["Comment"] == "payment events" and d["id"] == "string"
    assert spark.sql("SELECT current_schema()").first()[0]


def test_a_merge_that_breaks_off_leaves_the_old_rows(spark, tmp_root, monkeypatch):
    name = "broken_" + posixpath.basename(tmp_root).replace("-", "_")
    first = spark.createDataFrame([(1, "a", "h1"), (2, "b", "h2")], SCHEMA)
    TB.ensure_table(spark, name, first.schema, "t", location=posixpath.join(tmp_root, "broken"))
    TB.apply_sync_merge(spark, name, first, "k", "h")
    second = spark.createDataFrame([(1, "new", "hx"), (3, "c", "h3")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(TB.M, "merged_state", lambda plan: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            TB.apply_sync_merge(spark, name, second, "k", "h")
    assert sorted(r["k"] for r in spark.table(name).collect()) == [1, 2]
    assert TB.apply_sync_merge(spark, name, second, "k", "h") == {"INSERT": 1, "UPDATE": 1, "DELETE": 1, "KEEP": 0}
    assert sorted((r["k"], r["v"]) for r in spark.table(name).collect()) == [(1, "new"), (3, "c")]


def test_replace_table_keeps_comment_properties_and_types(spark, tmp_root):
    name = "rebuilt_" + posixpath.basename(tmp_root).replace("-", "_")
    schema = T.StructType([T.StructField("k", T.LongType())])
    TB.replace_table(spark.createDataFrame([(1,)], "k int"), name, "ids", {"pii": "false"}, schema)
    assert dict(spark.table(name).dtypes) == {"k": "bigint"}
    TB.replace_table(spark.createDataFrame([(2,)], "k int"), name, schema=schema)
    assert TB.table_properties(spark, name)["pii"] == "false" and spark.catalog.getTable(name).description == "ids"
    assert [r["k"] for r in spark.table(name).collect()] == [2]
    with pytest.raises(ValueError):
        TB.ensure_table(spark, name, T.StructType([T.StructField("k", T.StringType())]))


def test_an_emptied_snapshot_leaves_no_files(spark, tmp_root):
    import datetime as dt
    import glob
    name, loc = "emptied_" + posixpath.basename(tmp_root).replace("-", "_"), posixpath.join(tmp_root, "emptied")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("d", T.DateType())])
    TB.ensure_table(spark, name, schema, partition_by=["d"], location=loc)
    day = dt.date(2000, 1, 1)
    rows = spark.createDataFrame([(1, day)], schema)
    TB.replace_snapshot(rows, name, "d", day)
    TB.replace_snapshot(rows.limit(0), name, "d", day)
    assert spark.table(name).count() == 0 and not glob.glob(loc + "/d=*/*.parquet")
    with pytest.raises(ValueError):
        TB.replace_snapshot(rows, name, "d", dt.date(2000, 1, 2))


def test_a_snapshot_is_swapped_whole(spark, tmp_root):
    """A failed replacement leaves the old slice and no files; a reader of the slice replaced reads on."""
    import os
    name, loc = "swapped_" + posixpath.basename(tmp_root).replace("-", "_"), posixpath.join(tmp_root, "swapped")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("d", T.DateType())])
    TB.ensure_table(spark, name, schema, partition_by=["d"], location=loc)
    day = dt.date(2000, 1, 1)

    def rows(*ks):
        return spark.createDataFrame([(k, day) for k in ks], schema)

    assert TB.replace_snapshot(rows(1, 2), name, "d", day) == 2
    reader = spark.table(name).where(F.col("d") == day)
    plan = reader._jdf.queryExecution().executedPlan()       # files are listed
    calls = []
    broken = rows(3).select(F.when(F.col("k") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("k")).cast("int").alias("k"), "d")
    with pytest.raises(Exception):
        TB.replace_snapshot(broken, name, "d", day)

    def gate(written):
        calls.append(sorted(r.k for r in written.collect()))
        raise AssertionError("gate")

    with pytest.raises(AssertionError):
        TB.replace_snapshot(rows(4), name, "d", day, gate)
    assert calls == [[4]] and sorted(r.k for r in spark.table(name).collect()) == [1, 2]
    slices = f"{loc}__slices/d=2000-01-01"
    assert len(os.listdir(slices)) == 1
    TB.replace_snapshot(rows(5, 6, 7), name, "d", day)
    assert plan is not None and sorted(r.k for r in reader.collect()) == [1, 2]        # the plan made before
    assert sorted(r.k for r in spark.table(name).collect()) == [5, 6, 7]
    TB.replace_snapshot(rows(8), name, "d", day)
    assert len(os.listdir(slices)) == 2 and [r.k for r in spark.table(name).collect()] == [8]
