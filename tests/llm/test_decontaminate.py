import hashlib
import random
import re

from llm_cases import EDGE

from ledgerloom.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for item, text in items:
            x = words(text)
            n = min(10, len(x))
            windows = {tuple(x[s:s + n]) for s in range(len(x) - n + 1)} if n else set()
            for s in range(len(w) - n + 1) if n else ():
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    names.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(docs, items):
    return sorted(map(tuple, decontaminate.contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def corpus():
    r = random.Random(2)
    vocabulary = ["the", "of", "and", "Été", "naïve", *(f"w{i}" for i in range(60))]

    def text(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    items = [(i, text(r.choice([1, 2, 3, 5, 8, 9, 10, 11, 12, 30, 60]))) for i in range(40)]
    items += [(100, "the of the of the of the of the of the of the of"), (101, ""), (102, None), (3, items[5][1]), (None, text(20))]
    docs = []
    for i in range(150):
        parts = [text(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            x = words(r.choice(items)[1])
            a = r.randint(0, len(x))
            parts.append(" ".join(x[a:a + r.choice([4, 9, 10, 11, 25])]).upper() if r.random() < 0.3 else "--".join(x[a:]))
            parts.append(text(r.randint(0, 12)))
        docs.append((i, ", ".join(parts)))
    return docs + [(500, "the of " * 40)], items


def test_against_brute_force(spark, documents):
    docs, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert got(documents(docs), bench) == want
    assert sum(r[-1] for r in want) > 20


def test_only_long_items(spark, documents):
    docs, items = corpus()
    items = [x for x in items if len(words(x[1])) >= 10]
    assert got(documents(docs), spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_edge_rows(spark, documents):
    items = [(1, "some words here"), (2, "word " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(documents(EDGE, extra=True), bench) == brute(EDGE, items)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert got(documents(EDGE), empty) == brute(EDGE, [])
    assert got(documents([]), bench) == []


def test_rows_that_hold_an_item_leave(spark, documents):
    bench = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    kept = decontaminate.decontaminate(documents(EDGE, extra=True), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 7, 8] and "w" in kept.columns
