import hashlib
import random
import zlib

from llm_cases import EDGE

from ledgerloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def up(nodes):
    """All levels of one tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h(*x[i:i + 16]) for i in range(0, len(x), 16)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append((level[first:at], level[at + 1:first + 16]))
        at //= 16
    return out


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    def leaf(r, text):
        return h(*[field(v) for v in (r[0], r[3], r[2], r[4], text)])

    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    top = up([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, _, d, r) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            steps = path(trees[s], at) + path(top, k)
            forged = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            acc = leaf(r, lowered(r[1])) if forged else d
            for before, after in steps:
                acc = h(*before, acc, *after)
            root = top[-1][0]
            out.append((r[0], d, trees[s][-1][0], root, h(*[x for b, a in steps for x in b + a]), acc, acc == root))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, merkle.proofs(df, merkle.every_fifth_lowered()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_against_brute_force(spark):
    """A source of three levels, sources of 1, 2, 16, 17 and 256 rows, more sources than the fan-out, one null."""
    r = random.Random(3)
    sizes = {"hot": 700, None: 17, "é": 16, "a": 1, "Z": 2, "z": 256, **{f"s{i:02}": r.randint(1, 4) for i in range(20)}}
    rows = [(s, k) for s, n in sizes.items() for k in range(n)]
    r.shuffle(rows)
    rows = [(1000 - i if i % 3 else i, r.choice(["Some Text", "plain", "", None, "Ünï X"]), r.choice(["en", None]), s, r.choice([7, None]))
            for i, (s, _) in enumerate(rows)]
    want = brute(rows)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(7)) == want
    assert 0 < sum(not x[-1] for x in want) < len(want) / 4
    assert all(x[-1] or x[5] != x[3] for x in want)


def test_one_source_and_one_row(spark):
    for n in (1, 16, 18, 273):
        rows = [(i, f"Text {i}", "en", "only", 6) for i in range(n)]
        assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_equal_and_edge_rows(spark, documents):
    rows = [(i, t, None, "src", len(t) if t is not None else None) for i, t in EDGE] + [(9, "Same", "en", None, 4)] * 40
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("rank", "size", "grp", "tree", "d", "run", "steps", "lo"):
        df = df.selectExpr("*", f"1 AS {name}")
    # equal rows stand in any order, so each proof of the run occurs once
    assert got(df) == brute(rows)
    assert got(documents([])) == []


def test_nodes_nest(spark):
    rows = [(i, str(i), None, "ab"[i % 2], 1) for i in range(600)]
    nodes = merkle.nodes(merkle.manifest(spark.createDataFrame(rows, SCHEMA))).collect()
    inner = {(n.part, n.tree, n.level): [] for n in nodes}
    for n in nodes:
        inner[n.part, n.tree, n.level].append((n.lo, n.hi))
    assert {k: len(v) for k, v in inner.items() if k[0] == "source"} == {
        ("source", t, level): c for t in (0, 1) for level, c in enumerate([300, 19, 2, 1])}
    for spans in inner.values():        # each level covers all ranks without a gap
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
