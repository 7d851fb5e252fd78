import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import duplicate_keys, latest_per_key, rank_duplicates


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_latest_per_key_picks_newest_valid(spark):
    df = spark.createDataFrame([
        (1, dt.date(2000, 1, 2), 10, "ok"), (1, dt.date(2000, 1, 3), 20, "bad"),
        (1, dt.date(2000, 1, 1), 30, "ok"), (2, None, 40, "ok"), (2, dt.date(1999, 1, 1), 50, "ok"),
        (None, dt.date(2000, 1, 1), 60, "ok"), (None, dt.date(2000, 2, 1), 70, "ok"),
    ], "k int, d date, v int, status string")
    out = latest_per_key(df, ["k"], ["d"], where=F.col("status") == "ok")
    assert out.columns == df.columns
    # latest *valid*: the 2000-01-03 row is filtered first; NULL dates lose; NULL keys group
    assert rows(out, "k", "v") == sorted([(1, 10), (2, 50), (None, 70)], key=repr)
    assert out.count() == 3


def test_latest_per_key_ties_are_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b")], "k int, o int, p string")
    for _ in range(2):
        assert rows(latest_per_key(df.repartition(3), ["k"], ["o"]), "k", "p") == [(1, "c")]


def _skewed(spark):
    # key 0 holds a third of all rows; timestamps collide to exercise the tie hash
    data = [(0 if i % 3 == 0 else i % 50, dt.datetime(2000, 1, 1 + i % 5), i % 7, f"r{i}") for i in range(900)]
    data += [(None, dt.datetime(2000, 1, 1), 1, "n1"), (None, None, 2, "n2")]
    return spark.createDataFrame(data, "k int, ts timestamp, amt int, payload string")


def test_rank_strategies_agree_on_skewed_keys(spark):
    df = _skewed(spark)
    kw = dict(keys=["k"], order=["ts"], tie_cols=["amt", "payload"])
    w = rows(rank_duplicates(df, strategy="window", **kw), "payload", "duplicate_rank")
    s = rows(rank_duplicates(df, strategy="sorted", **kw), "payload", "duplicate_rank")
    a = rows(rank_duplicates(df, strategy="auto", hot_rows=100, hot_share=0.5, **kw), "payload", "duplicate_rank")
    assert w == s == a
    ranked = rank_duplicates(df, strategy="sorted", **kw)
    per_key = ranked.groupBy("k").agg(F.count("*").alias("n"), F.max("duplicate_rank").alias("mx"),
                                      F.count_distinct("duplicate_rank").alias("d"))
    assert per_key.where((F.col("n") != F.col("mx")) | (F.col("n") != F.col("d"))).count() == 0


def test_null_keys_rank_together(spark):
    df = _skewed(spark)
    r = rank_duplicates(df, ["k"], ["ts"], strategy="auto", hot_rows=100, hot_share=0.5).where(F.col("k").isNull())
    assert rows(r, "payload", "duplicate_rank") == [("n1", 1), ("n2", 2)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(duplicate_keys(df, ["k"]), "k", "row_count") == sorted([(1, 2), (None, 2)], key=repr)


def test_hot_key_threshold_is_relative_to_partition_size(spark):
    from ledgerloom.operators.dedupe import _hot_keys
    df = _skewed(spark)          # key 0 holds 300 of 902 rows
    assert _hot_keys(df, ["k"], 100, 0.5) is not None
    # 300 rows is not hot when an average partition already holds ~900/4 * 4 rows
    assert _hot_keys(df, ["k"], 100, 8.0) is None


def test_paths_agree_beyond_the_tie_hash(spark):
    """Rows equal in key, order and tie columns are ranked by their other columns, on both paths."""
    df = spark.createDataFrame([(1, 5, "t", x) for x in (10, 30, 20)] + [(2, 1, "t", 7)], "k int, o int, t string, other int")
    want = [(30, 1), (20, 2), (10, 3), (7, 1)]
    for strategy in ("window", "sorted", "auto"):
        out = rank_duplicates(df.repartition(3), ["k"], ["o"], ["t"], strategy=strategy)
        assert rows(out, "other", "duplicate_rank") == sorted(want, key=repr)
        assert dict(out.dtypes)["duplicate_rank"] == "bigint"


def test_hot_keys_have_no_limit_and_come_from_one_aggregate(spark):
    from ledgerloom.operators.dedupe import _hot_keys
    df = spark.range(3000).selectExpr("id % 5 AS k")
    assert {r[0] for r in _hot_keys(df, ["k"], hot_rows=100, hot_share=0.1).collect()} == set(range(5))
    assert _hot_keys(df, ["k"], hot_rows=10_000) is None
    assert _hot_keys(df.limit(0), ["k"], hot_rows=100) is None
