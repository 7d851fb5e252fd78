import random
import re

import numpy as np
import pytest
from llm_cases import EDGE

from ledgerloom.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^ \t\n\x0b\x0c\r]+")


def shares(sizes, weights=(5, 2, 1), repeats=3):
    """Targets by sharing the excess again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, todo, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while todo > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            out[s] += todo * weight[s] / total
        todo = 0.0
        for s in list(open_):
            if out[s] >= repeats * sizes[s]:
                todo += out[s] - repeats * sizes[s]
                out[s] = float(repeats * sizes[s])
                open_.discard(s)
    return out


def corpus(n=400, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if r.random() < 0.35 else r.choice(["b", "c", "é", "Z", None, "tiny"] if i % 40 == 0 else ["b", "c", "é", "Z", None])
        text = r.choice([None, "", " \t"]) if r.random() < 0.05 else " ".join(f"w{r.randint(0, 99)}" for _ in range(r.choice([3, 10, 60])))
        rows.append((i, text, None, source, 1))
    return rows


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)
    monkeypatch.setattr(mixing, "SHARD", 8)
    monkeypatch.setattr(mixing, "CHUNK", 4)
    monkeypatch.setattr(mixing, "LEVELS", 2)


def check(rows, out):
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want, source = shares(sizes), {r[0]: r[3] for r in rows}
    text, words = {r[0]: r[1] for r in rows}, dict.fromkeys(sizes, 0)
    assert len(out) == len(rows)
    for r in out:
        s = source[r.doc_id]
        assert r.size == len(WORD.findall(text[r.doc_id] or "")) and r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s], rel=1e-12, abs=1e-9) and 0 <= r.taken <= 3 * r.size
        words[s] += r.taken
    for s in sizes:
        assert abs(words[s] - want[s]) <= 0.5 + 1e-6
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    return words


def test_targets_and_words(spark, small):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.taken(df.repartition(5)).collect()
    words = check(rows, out)
    tiny = {r[0] for r in rows if r[3] == "tiny"}
    assert all(r.taken == 3 * r.size for r in out if r.doc_id in tiny) and words["tiny"]
    # reruns agree, however the rows are partitioned
    again = mixing.taken(df.orderBy(df.doc_id.desc()).coalesce(1)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_blocks_of_production_size(spark):
    """All in one block and one shard: the cut falls inside it."""
    rows = corpus(120, seed=2)
    check(rows, mixing.taken(spark.createDataFrame(rows, SCHEMA)).collect())


def test_mixture(spark, small):
    """Shards hold their draws once each, in gapless places, and the sources in about the proportion of the whole."""
    rows = corpus(1500, seed=3)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS size", "3 AS draws")
    out = [r.asDict() for r in mixing.mix(df.drop("shard")).collect()]
    taken = {r.doc_id: r.taken for r in mixing.taken(df).collect()}
    got, seen = {}, set()
    for r in out:
        assert (r["doc_id"], r["epoch"]) not in seen and 0 < r["words"]
        seen.add((r["doc_id"], r["epoch"]))
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["words"]
    assert got == {i: n for i, n in taken.items() if n}
    shards = {}
    for r in out:
        shards.setdefault(r["shard"], []).append(r)
    assert len(shards) > 10
    for held in shards.values():
        assert sorted(r["place"] for r in held) == list(range(len(held)))
    share = {s: sum(r["words"] for r in out if r["source"] == s) / sum(r["words"] for r in out) for s in ("hot", "b")}
    for s, want in share.items():
        mean = np.mean([sum(r["words"] for r in held if r["source"] == s) / sum(r["words"] for r in held) for held in shards.values()])
        assert abs(mean - want) < 0.1


def test_quotas_are_exact_and_disjoint(spark, small):
    draws = {0: 100, 2: 7, 5: 333, 6: 1, 9: 60}
    rows = mixing.shard_quotas(spark.createDataFrame(list(draws.items()), "src long, draws long"), shard=8).collect()
    held, sizes = {}, {}
    for r in rows:
        held.setdefault(r.src, []).extend(range(r.begin, r.begin + r.quota))
        sizes[r.shard] = sizes.get(r.shard, 0) + r.quota
    assert {s: sorted(v) for s, v in held.items()} == {s: list(range(n)) for s, n in draws.items()}
    assert len(sizes) == 63 and set(sizes.values()) <= {7, 8}


def test_the_tree_samples_without_replacement(spark):
    """Over many seeds the first shard's quota has the mean and variance of the hypergeometric distribution."""
    got = []
    for seed in range(400):
        node = {"lo": 0, "hi": 4, "draws": [30, 50, 20], "begins": [0, 0, 0]}
        import pyarrow as pa
        batch = pa.RecordBatch.from_pylist([node])
        got.append(next(mixing._split(100, 4, seed, 10)(iter([batch]))).to_pylist())
    first = np.array([g[0]["draws"] if g[0]["lo"] == 0 else next(x["draws"] for x in g if x["lo"] == 0) for g in got])
    assert np.allclose(first.mean(0), [7.5, 12.5, 5], atol=0.35)
    assert np.allclose(first.var(0), [25 * .3 * .7 * 75 / 99, 25 * .5 * .5 * 75 / 99, 25 * .2 * .8 * 75 / 99], rtol=0.3)


def test_edge_and_repeated_rows(spark, documents, small):
    rows = [(i, t, None, s, 1) for (i, t), s in zip(EDGE, [None, "a", "a", "b", "b", "b", "c", "b", None, "a"])]
    rows += [(77, "nine words here " * 3, None, "r", 1)] * 60
    out = mixing.taken(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS copy", "1 AS rank", "2 AS body")).collect()
    assert len(out) == len(rows) and all(r.taken <= 3 * r.size for r in out)
    words = sum(r.taken for r in out if r.doc_id == 77)
    assert abs(words - next(r.target for r in out if r.doc_id == 77)) <= 0.5
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.words for r in mixed) == sum(r.taken for r in out)
    assert mixing.taken(documents([])).collect() == [] and mixing.mix(documents([])).collect() == []
    none = mixing.taken(documents([(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2
