import random
import re

import xxhash
from llm_cases import EDGE

from ledgerloom.llm import simhash


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(fps, radius=3):
    """Smallest id reachable, by comparing all pairs."""
    up = {i: i for i in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= radius:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus():
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 300)))) for i in range(120)]
    for i in range(60):                       # copies, near copies, chains
        words = rows[r.randrange(len(rows))][1].split()
        if i % 3:
            words[r.randrange(len(words))] = "changed"
        rows.append((200 + i, " ".join(words).upper() if i % 5 == 0 else "\n".join(words)))
    return rows + [(900, "a"), (901, "a a"), (902, None), (903, "   ")]


def test_against_brute_force(documents):
    rows = corpus()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(documents(rows)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    want = brute_components(fps)
    assert got == {i: (format(fps[i], "016x"), want[i]) for i in fps}
    assert got[902] == got[903] == ("0" * 16, 902)


def test_links_over_many_small_blocks(spark):
    r = random.Random(8)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(12)})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    from ledgerloom.llm.common import components
    roots = {r.node: r.root for r in components(simhash.links(df, block=7)).collect()}
    names = {x: i for i, x in enumerate(fps)}
    want = brute_components({names[x]: x for x in fps})
    signed = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    groups = {}
    for s, x in signed.items():
        groups.setdefault(roots.get(s, s), set()).add(want[names[x]])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_long_texts_are_hashed_in_slices(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    want = brute_fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE_BYTES", 100)
    assert simhash.fingerprint(text) == want


def test_edge_rows(documents):
    out = simhash.simhash_components(documents(EDGE, extra=True)).collect()
    assert len(out) == len(EDGE)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in out}
    f = format(brute_fingerprint("some words here"), "016x")
    assert by[(None, f)] == by[(4, f)] == 4
    assert simhash.simhash_components(documents([])).count() == 0


def test_keep_one_of_each_group(documents):
    kept = simhash.keep_one(documents(EDGE, extra=True))
    assert "th" in kept.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == [1, 4, 5, 6, 7, 8]          # the blank texts are one group; the repeated row once
    alone = simhash.keep_one(documents([(None, "only this one"), (None, "only this one")]))
    assert alone.count() == 1
    assert simhash.keep_one(documents([])).count() == 0
