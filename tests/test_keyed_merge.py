"""Bucket-wise merges: what is read and written, growth, and runs that are lost."""
import posixpath
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import merge as M
from ledgerloom.sinks import keyed as K

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("h", T.StringType())])


@pytest.fixture()
def table(spark, tmp_root, request):
    name = f"keyed_{abs(hash(request.node.name)) % 10**9}"
    K.declare_keyed(spark, name, SCHEMA, location=posixpath.join(tmp_root, "t"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows_of(spark, name):
    return sorted(((r.k, r.v, r.h) for r in spark.table(name).collect()), key=str)


def run(spark, name, rows, **kw):
    return K.sync(spark, name, spark.createDataFrame(rows, SCHEMA), "k", "h", **{"span": 16, "bucket_rows": 100, **kw})


def actions(counts):
    return tuple(counts[a] for a in (M.INSERT, M.UPDATE, M.DELETE, M.KEEP))


def test_a_merge_of_few_key_ranges_touches_few_files(spark, table):
    rows = {i: (i, f"v{i}", f"h{i}") for i in range(6400)}
    first = run(spark, table, list(rows.values()))
    assert actions(first) == (6400, 0, 0, 0) and first["buckets"] == 64
    before = K.files_of(spark, table)
    for i in range(3200, 3264):                   # one per cent of the keys
        rows[i] = (i, "new", "x")
    counts = run(spark, table, list(rows.values()))
    assert actions(counts) == (0, 64, 0, 6336) and counts["read"] <= 4 and counts["written"] <= 4
    after = K.files_of(spark, table)
    assert len(before - after) <= 4 and len(before & after) >= 0.9 * len(before)
    assert rows_of(spark, table) == sorted(rows.values(), key=str)
    again = run(spark, table, list(rows.values()))
    assert actions(again) == (0, 0, 0, 6400) and again["read"] == again["written"] == 0
    assert K.files_of(spark, table) == after


def test_buckets_split_as_the_table_grows(spark, table):
    rows = [(i, f"v{i}", f"h{i}") for i in range(1000)]
    assert run(spark, table, rows)["buckets"] == 10
    before = K.files_of(spark, table)
    counts = run(spark, table, rows + [(i, f"v{i}", f"h{i}") for i in range(1000, 1150)])
    assert counts["buckets"] == 12 and actions(counts) == (150, 0, 0, 1000)
    assert before & K.files_of(spark, table), "buckets that neither split nor changed keep their files"
    slots = spark.table(table)
    wrong = slots.where(slots[K.BUCKET] != K.bucket_of(K._slot(slots, "k", 16), 12))
    assert wrong.isEmpty() and spark.table(table).count() == 1150
    assert run(spark, table, rows)["DELETE"] == 150 and rows_of(spark, table) == sorted(rows, key=str)


def test_linear_hashing_moves_rows_of_the_split_bucket_only(spark):
    df = spark.range(2000).selectExpr("xxhash64(id) AS s")
    for had in (1, 2, 3, 5, 8, 13):
        for r in df.select(K.bucket_of(df.s, had).alias("a"), K.bucket_of(df.s, had + 3).alias("b")).distinct().collect():
            assert r.a == K.parent(r.b, had) and 0 <= r.b < had + 3


def test_against_a_plain_merge(spark, table):
    r, want = random.Random(1), {}
    for step in range(4):
        source = {k: (k, f"{k}-{r.randint(0, 2)}", None) for k in r.sample(range(500), 300)}
        source = {k: (k, v, None if k % 50 == 7 else v) for k, (_, v, _) in source.items()}
        counts = run(spark, table, list(source.values()), bucket_rows=40)
        keep = {k for k in want if k in source and (want[k][2] is None or source[k][2] is None or want[k][2] == source[k][2])}
        assert actions(counts) == (len(source.keys() - want.keys()), len((want.keys() & source.keys()) - keep),
                                   len(want.keys() - source.keys()), len(keep))
        want = {k: want[k] if k in keep else row for k, row in source.items()}
        assert rows_of(spark, table) == sorted(want.values(), key=str), step


def test_null_and_repeated_keys(spark, table):
    rows = [(None, "a", "1"), (1, "b", "2")]
    assert actions(run(spark, table, rows)) == (2, 0, 0, 0)
    assert actions(run(spark, table, rows)) == (1, 0, 1, 1)         # null keys never match
    with pytest.raises(M.MergeCardinalityError):
        run(spark, table, [(1, "b", "2"), (1, "c", "3")])
    assert rows_of(spark, table) == sorted(rows, key=str)
    assert actions(run(spark, table, [])) == (0, 0, 2, 0) and rows_of(spark, table) == []


@pytest.mark.parametrize("lost_at", ["before the record", "at the first partition", "at a later partition"])
def test_a_lost_run_leaves_the_old_rows_or_is_completed(spark, table, monkeypatch, lost_at):
    first = [(i, "a", "a") for i in range(400)]
    run(spark, table, first)
    second = [(i, "b", "b") for i in range(0, 700)]
    calls, sql, put = [], type(spark).sql, K.TB.set_table_properties

    def broken_sql(self, text, *a, **kw):
        if "SET LOCATION" in text or "ADD IF NOT EXISTS" in text:
            calls.append(text)
            if len(calls) == (1 if lost_at == "at the first partition" else 4):
                raise RuntimeError("lost")
        return sql(self, text, *a, **kw)

    def broken_put(spark, table, comment=None, props=None):
        if props and props.get("merge.pending"):
            raise RuntimeError("lost")
        return put(spark, table, comment, props)

    with monkeypatch.context() as m:
        if lost_at == "before the record":
            m.setattr(K.TB, "set_table_properties", broken_put)
        else:
            m.setattr(type(spark), "sql", broken_sql)
        with pytest.raises(RuntimeError):
            run(spark, table, second)
    if lost_at == "before the record":
        assert rows_of(spark, table) == sorted(first, key=str)
        assert actions(run(spark, table, second)) == (300, 400, 0, 0)
    else:      # the next merge completes it first
        assert actions(run(spark, table, second)) == (0, 0, 0, 700)
    assert rows_of(spark, table) == sorted(second, key=str)


def test_facts_are_those_of_the_table_and_do_not_read_it(spark, table):
    kept = {"a_rows": F.count(F.when(F.col("v") == "a", 1)), "k_sum": F.sum("k")}
    r, rows = random.Random(5), {}

    def check(**more):
        counts = run(spark, table, list(rows.values()), bucket_rows=30, **more)
        got = K.facts(spark, table, *(["a_rows", "k_sum"] if more else [])).first().asDict()
        want = {"rows": len(rows), "distinct_keys": len(rows), "duplicate_rows": 0}
        if more:
            want |= {"a_rows": sum(v == "a" for _, v, _ in rows.values()), "k_sum": sum(rows)}
        assert got == want
        return counts

    for step in range(3):
        for k in r.sample(range(300), 120):
            v = r.choice("abc")
            rows[k] = (k, v, v)
        for k in r.sample(sorted(rows), 10):
            del rows[k]
        check(kept=kept)
    check()                 # without facts, and with them again: added up from the table once
    assert check(kept=kept)["read"] == 0
    rows.clear()
    check(kept=kept)
    files = K.facts(spark, table, "k_sum").inputFiles()
    assert files and all("__summaries" in f for f in files)
    run(spark, table, [(1, "a", "a"), (None, "b", "b"), (2, "c", "c")])
    assert K.facts(spark, table).first()[:] == (3, 2, 1)


def test_repeated_keys_show_in_the_facts(spark, table):
    run(spark, table, [(1, "a", "a"), (1, "b", "b"), (2, "c", "c")])
    assert K.facts(spark, table).first()[:] == (3, 2, 1)


def test_empty_buckets_are_not_read_again(spark, table):
    rows = [(i, "a", "a") for i in range(40)]          # three runs of keys, eight buckets
    assert run(spark, table, rows, bucket_rows=5)["buckets"] == 8
    again = run(spark, table, rows, bucket_rows=5)
    assert again["read"] == again["written"] == 0 and actions(again) == (0, 0, 0, 40)
