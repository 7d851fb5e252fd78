import random

import xxhash
from llm_cases import EDGE
from pyspark.sql import DataFrame

from ledgerloom.llm import line_dedup

def shingles(line):
    """The five characters at every position."""
    return {line[i:i + 5] for i in range(max(1, len(line) - 4))}


def brute(rows, similarity=0.8):
    """Exact-Jaccard components over all pairs of distinct lines; the first line in the smallest id stays."""
    lines = [(i, n, x.strip(" \t\r\x0b\x0c").lower()) for i, t in rows for n, x in enumerate((t or "").split("\n")) if x.strip(" \t\r\x0b\x0c")]
    distinct = sorted({x for _, _, x in lines})
    sets = {x: shingles(x) for x in distinct}
    up = {x: x for x in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, a in enumerate(distinct):
        for b in distinct[n + 1:]:
            both = len(sets[a] & sets[b])
            if both >= similarity * len(sets[a] | sets[b]) and both:
                up[find(a)] = find(b)
    owner, seen, cut = {}, set(), set()
    for i, n, x in sorted(lines):
        owner.setdefault(find(x), i)
    for i, n, x in sorted(lines):
        if owner[find(x)] != i or (i, find(x)) in seen:
            cut.add((i, n))
        seen.add((i, find(x)))
    return {i: "\n".join(x for n, x in enumerate((t or "").split("\n")) if (i, n) not in cut) for i, t in rows}


def corpus(n=90):
    r = random.Random(11)
    vocabulary = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 9))) for _ in range(500)]

    def line(k):
        return " ".join(r.choice(vocabulary) for _ in range(k))

    stock = [line(r.randint(1, 60)) for _ in range(60)]
    rows = []
    for i in range(n):
        lines = [line(r.randint(1, 60)) for _ in range(r.randint(1, 4))]
        for _ in range(r.randint(0, 3)):
            words = r.choice(stock).split()
            if r.random() < 0.6 and len(words) > 25:        # far enough above the threshold to meet in a band
                words[r.randrange(len(words))] = "changed"
            lines.insert(r.randrange(len(lines) + 1), " ".join(words) + r.choice(["", " ", "\t"]))
        if r.random() < 0.3:
            lines.append("")
        rows.append((i, "\n".join(lines)))
    return rows


def test_against_brute_force(documents):
    rows = corpus()
    out = {r.doc_id: r for r in line_dedup.dedup_lines(documents(rows)).collect()}
    want = brute(rows)
    assert {i: r.text for i, r in out.items()} == want
    assert all(r.n_lines == len(t.split("\n")) for (i, t), r in zip(rows, (out[i] for i, _ in rows)))
    assert sum(r.n_dropped for r in out.values()) == sum(
        len(t.split("\n")) for _, t in rows) - sum(len(t.split("\n")) if t or not out[i].n_dropped else 0 for i, t in want.items())


def test_a_large_group_of_near_copies_keeps_one_line(documents):
    words = [f"word{i}x" for i in range(80)]
    rows = [(i, " ".join(words[:i % 80] + [f"v{i}"] + words[i % 80 + 1:])) for i in range(300)]
    out = line_dedup.dedup_lines(documents(rows)).collect()
    assert sum(r.n_dropped for r in out) == 299
    assert next(r.text for r in out if r.doc_id == 0) == rows[0][1]


def test_members_far_from_the_centres_are_compared_in_blocks(documents, monkeypatch):
    """With one centre a group and tiny blocks nearly all links come from the comparison of blocks."""
    monkeypatch.setattr(line_dedup, "CENTRES", 1)
    monkeypatch.setattr(line_dedup, "BLOCK", 2)
    words = [f"word{i}x" for i in range(60)]
    rows = corpus(40)
    for i in range(60):           # a chain: each line is similar to the next, the ends are not
        rows.append((500 + i, " ".join(f"w{j}y" if j < 2 * (i % 20) else w for j, w in enumerate(words)) + f" tail{i}"))
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(rows)).collect()} == brute(rows)


def test_scripts_without_spaces(documents):
    a = "".join(chr(0x4E00 + 7 * i) for i in range(200))
    rows = [(1, a), (2, a[:90] + "新" + a[91:]), (3, a[::-1])]
    out = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(documents(rows)).collect()}
    assert out == {1: 0, 2: 1, 3: 0}


def test_edge_rows(documents):
    out = line_dedup.dedup_lines(documents(EDGE, extra=True))
    assert "root" in out.columns
    rows = out.collect()
    assert len(rows) == len(EDGE)
    got = [(r.doc_id, r.text, r.n_dropped) for r in rows]
    assert got.count((4, "some words here", 0)) == 2 and (None, "", 1) in got      # equal rows, equal results
    assert (8, "a\nb\n", 1) in got and (1, "", 0) in got and (2, "", 0) in got
    assert (5, "x" * 200_000, 0) in got
    assert line_dedup.dedup_lines(documents([])).count() == 0


def test_hash_names_are_independent(spark):
    row = spark.sql("SELECT xxhash64('body') AS a, xxhash64('line', 'body') AS b").first()
    assert row.a != row.b and row.a % (1 << 64) == xxhash.xxh64_intdigest(b"body", 42)


def caught(documents, pairs):
    """The share of pairs of lines whose second line is cut."""
    rows = [(2 * i + side, line) for i, pair in enumerate(pairs) for side, line in enumerate(pair)]
    out = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(documents(rows)).collect()}
    assert not any(out[2 * i] for i in range(len(pairs)))
    return sum(out[2 * i + 1] for i in range(len(pairs))) / len(pairs)


def test_recall_of_edited_lines(documents):
    """Of the pairs with a similarity of 0.8 or more over all five-character shingles, 0.9 and more are found."""
    r = random.Random(7)

    def line(words):
        return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(words))

    kinds = {
        "changed": [(x, x[:(i := r.randrange(len(x)))] + "#" + x[i + 1:]) for w in (8, 12, 20) for x in (line(w) for _ in range(60))],
        "inserted": [(x, x[:(i := r.randrange(len(x)))] + "#" + x[i:]) for w in (10, 30) for x in (line(w) for _ in range(80))],
        "unspaced": [(x, x[:(i := r.randrange(len(x)))] + "ก" + x[i:]) for x in (
            "".join(chr(0x0E01 + r.randrange(46)) for _ in range(400)) for _ in range(60))],
        "two words": [(x, " ".join("new" if i in (5, 30) else w for i, w in enumerate(x.split()))) for x in (line(40) for _ in range(80))],
    }
    for kind, pairs in kinds.items():
        similar = [(a, b) for a, b in pairs if len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b))]
        assert len(similar) >= 40
        assert caught(documents, similar) >= 0.9, kind


def test_a_document_of_many_lines(documents):
    """Equal lines and different ones, 60,000 in one document: cut in time in proportion to them."""
    text = "\n".join("the same line" if i % 2 else f"{i * 7919 % 100_003:x}" for i in range(60_000))
    r = line_dedup.dedup_lines(documents([(1, text)])).collect()[0]
    assert r.n_lines == 60_000 and r.n_dropped == 29_999 and r.text.count("the same line") == 1
    assert r.text.split("\n")[:4] == ["0", "the same line", f"{2 * 7919 % 100_003:x}", f"{4 * 7919 % 100_003:x}"]


def test_lines_that_are_near_no_centre_still_meet(documents, monkeypatch):
    """All lines stand in one band's group; only the near copies that are no centres and near none are similar."""
    monkeypatch.setattr(line_dedup, "CENTRES", 4)
    monkeypatch.setattr(line_dedup, "BANDS", [()])
    r = random.Random(3)
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(80)) + "x") for i in range(60)]
    rows += [(100 + i, rows[i][1] + "y") for i in range(60)]
    got = {x.doc_id: x.n_dropped for x in line_dedup.dedup_lines(documents(rows)).collect()}
    assert got == {i: int(i >= 100) for i, _ in rows}


def test_no_python_runs_on_the_executors(documents, monkeypatch):
    """Lines that stand in one band's group, near no centre, are compared by DataFrame operations, too."""
    def refused(*_, **__):
        raise AssertionError("Python on the executors")

    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(DataFrame, name, refused)
    monkeypatch.setattr(line_dedup, "CENTRES", 1)
    monkeypatch.setattr(line_dedup, "BANDS", [()])
    a, b = "some words that stand in two lines", "and others that stand in two more lines"
    rows = [(1, "unlike all"), (2, a), (3, b), (4, a + "!"), (5, b + "!")]
    got = {x.doc_id: x.n_dropped for x in line_dedup.dedup_lines(documents(rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}


def test_hashes_of_all_scripts(spark):
    """One hash for each place of five characters, of one to four bytes each."""
    bodies = ["abc", "abcde", "abcdefg", "añoßé€uro", "\u65b0\u805e", "x\U0001f600y\U0001f601z\U0001f602\u0e01", "\U0001f600" * 7, "ß"]
    lines = spark.createDataFrame(list(enumerate(bodies)), "doc long, body string").selectExpr("doc", "body", "doc AS k1", "doc AS k2")
    got = sorted((r.doc, r.h % (1 << 64)) for r in line_dedup._rows(lines).collect())
    assert got == sorted((i, xxhash.xxh64_intdigest(x[k:k + 5].encode(), 42)) for i, x in enumerate(bodies) for k in range(max(1, len(x) - 4)))


def test_agreement_of_packed_sketches(spark):
    r = random.Random(5)
    top = (1 << 14) - 1
    sides = [[r.choice([0, 1, top, r.randrange(top)]) for _ in range(20)] for _ in range(60)]
    names = ", ".join(f"m{i} long" for i in range(20))
    frame = spark.createDataFrame([[n, *[(r.getrandbits(49) << 14 | m) - (1 << 62) for m in side]] for n, side in enumerate(sides)],
                                  f"n long, {names}").select("n", *line_dedup._sketch())
    both = frame.alias("x").join(frame.alias("y")).select("x.n", "y.n", line_dedup._agreeing("x", "y"))
    assert all(k == sum(a == b for a, b in zip(sides[n], sides[m])) for n, m, k in map(tuple, both.collect()))
