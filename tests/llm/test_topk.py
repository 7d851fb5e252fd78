import math

import numpy as np

from ledgerloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def held(x):
    return max(-(1 << 63), min(x, (1 << 63) - 1))


def brute(rows, every=20, k=20):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % every == 0:
            best = sorted((-held(sum(a * b for a, b in zip(q, v))), j) for m, (j, v) in enumerate(ok) if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **more):
    return sorted(map(tuple, topk.search(spark.createDataFrame(rows, SCHEMA).repartition(3), **more).collect()))


def test_against_brute_force(spark):
    r = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in r.normal(size=16) / 4], 0) for i in r.permutation(500)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, every=7, k=3, slices=5, block=64) == brute(rows, 7, 3)


def test_ties_copies_and_large_values(spark):
    rows = [(i, [1.0, 0.5], 0) for i in range(70)] + [(100 + i, [0.0, -1.0], 0) for i in range(5)]
    rows += [(200, [3e30, 1.0], 0), (220, [1e6, 1e6], 0), (240, [], 0), (260, [1.0], 0)]
    assert run(spark, rows, block=16) == brute(rows)


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (20, None, 0), (40, [1.0, None], 0), (60, [float("nan"), 1.0], 0),
            (80, [float("inf"), 1.0], 0), (None, [1.0, 1.0], 0), (-20, [0.5, -0.5], None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(1, [1.0], 0)]) == [] == run(spark, [])
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS qb", "2 AS block", "3 AS rank", "4 AS query_id")
    assert sorted(map(tuple, topk.search(wide).collect())) == brute(rows)


def test_uniform_threshold_collects_few_entries():
    q = np.random.default_rng(1).normal(size=(8, 32)).round(2) * 64 // 1
    a, b = topk._partials(q, q, 2)
    assert (a + b == q @ q.T).all()
