import random
import re
import zlib

import corpus_pipeline as P
from llm_cases import EDGE
from test_decontaminate import brute as contaminated
from test_line_dedup import brute as deduplicated
from test_simhash import brute_components, brute_fingerprint

from ledgerloom.llm import packing


def corpus():
    r = random.Random(9)
    vocabulary = ["the", "of", *("".join(r.choice("etaoinshr") for _ in range(r.randint(2, 9))) for _ in range(400))]

    def line(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    items = [(i, line(r.randint(12, 40))) for i in range(10)]
    rows = [(i, "\n".join(line(r.randint(3, 60)) for _ in range(r.randint(1, 5))), "en") for i in range(120)]
    for i in range(30):
        t = rows[r.randrange(120)][1]
        rows.append((200 + i, t if i % 2 else t.replace(" the ", " teh ", 1), "en"))
    for i in range(10):
        rows.append((300 + i, line(30) + " " + items[i][1] + " " + line(5), "en"))
    return rows + [(400, "123 456 !!", "en"), (401, None, None), (402, "", "en")], items


def write(spark, root, rows, items):
    spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")


def test_against_brute_force(spark, tmp_root):
    rows, items = corpus()
    write(spark, tmp_root, rows, items)
    docs = [(i, t) for i, t, _ in rows if t and re.search(r"[^\W\d_]", t)]
    before = dict(docs)
    after = deduplicated(docs)
    docs = [(i, t) for i, t in after.items() if t == before[i] or t.strip()]
    groups = brute_components({i: brute_fingerprint(t) for i, t in docs})
    docs = [(i, t) for i, t in docs if groups[i] == i]
    bad = {r[0] for r in contaminated(docs, items) if r[-1]}
    assert bad
    docs = {i: t for i, t in docs if i not in bad}
    out = P.run(spark, tmp_root).toPandas()
    assert set(out.doc_id) == set(docs)
    encode = packing.encoder("byte_bpe_50k")
    for i, t in docs.items():
        assert set(out[out.doc_id == i].doc_tokens) == {len(encode(t)) + 1}
    assert sorted(out.sequence_id * 2048 + out.offset) == list(
        (out.sort_values(["sequence_id", "offset"]).length.cumsum() - out.sort_values(["sequence_id", "offset"]).length))


def test_stages_keep_the_columns_and_take_edge_rows(spark, documents, tmp_root):
    write(spark, tmp_root, [], [(1, "some words here")])
    for rows in (EDGE, []):
        docs = documents([(*x, "en") for x in rows], extra=True)
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, tmp_root)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            out.collect()
        assert P.STAGES[-1][1](spark, docs, tmp_root).count() >= 0


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_duplicates", "benchmark_decontamination", "packing"]
    assert P.ORACLE_SQL is None and zlib is not None


FOREIGN = ["Привет мир, как дела сегодня у вас дома", "日本語のテキストです", "Ελληνικά γλώσσα κείμενο",
           "xqjz vkwp zzqx jjkv wqxz pqzj xkcd vbzq " * 20, "ж" * 5000, "1 2 3", ""]


def test_texts_of_no_learned_language_go(spark, tmp_root):
    """Other scripts and letters in no order of the learned languages go; every document of the given table stays."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(FOREIGN)]
    mixed = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in P.language_id(spark, mixed, sf).select("doc_id").collect()}
    lettered = {r.doc_id for r in docs.where(docs.text.rlike(r"\p{L}")).select("doc_id").collect()}
    assert len(lettered) > 150 and kept == lettered


def test_short_texts_of_a_learned_language_stay(spark, documents, tmp_root):
    r = random.Random(2)
    vocabulary = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8))) for _ in range(300)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 5, 40]))), "en") for i in range(300)]
    assert P.language_id(spark, documents(rows), tmp_root).count() == 300


def test_unlabelled_corpus_keeps_texts_with_letters(spark, documents, tmp_root):
    kept = P.language_id(spark, documents([(1, "abc"), (2, "12"), (3, None)]), tmp_root)
    assert [r.doc_id for r in kept.collect()] == [1]
