import random
import zlib

import numpy as np
from llm_cases import EDGE

from ledgerloom.llm import language

SYLLABLES = {"xx": ["ka", "to", "mi", "ru", "é"], "yy": ["sch", "ung", "ein", "ü", "pf"], "zz": ["ción", "ar", "os", "ll", "ñ"]}


def corpus(n=400):
    r = random.Random(1)
    rows = []
    for i in range(n):
        lang = r.choice(list(SYLLABLES))
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(3, 80)))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang))
    return rows


def test_held_out_accuracy(documents):
    rows = corpus()
    out = {r.doc_id: r for r in language.identify(documents(rows)).collect()}
    assert {i: r.held_out for i, r in out.items()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows}
    held = [(out[i].lang_pred, lang) for i, _, lang in rows if out[i].held_out]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(documents):
    rows = corpus(150)
    wrong = [(i, t, "qq" if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, t, x in rows]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(documents(x)).collect()} for x in (rows, wrong))
    assert a == b


def test_every_label_is_learned(documents):
    """150 labels in three blocks, each with letters of its own and the later ones rarer."""
    r = random.Random(5)
    rows = [(200 * k + i, "".join(chr(0x4E00 + 9 * k + r.randrange(9)) for _ in range(40)), f"l{k:03}")
            for k in range(150) for i in range(30 if k < 64 else 12)]
    out = {x.doc_id: x.lang_pred for x in language.identify(documents(rows)).collect()}
    assert out == {i: lang for i, _, lang in rows}


def naive(texts):
    """All n-grams of each text, one by one."""
    out = []
    for t in texts:
        said = [0 if new else ord(c) for c in "" for new in ()]
        for c in t.lower() + " ":
            said.append(ord(c) if c.isalpha() else 32)
        said = [c for i, c in enumerate(said) if c != 32 or i == 0 or said[i - 1] != 32]
        grams = []
        for n in range(1, 4):
            for i in range(len(said) - n + 1):
                if n > 1 or said[i] != 32:
                    h = n
                    for c in said[i:i + n]:
                        h = (h ^ c) * 0x9E3779B97F4A7C15 % (1 << 64)
                        h ^= h >> 29
                    grams.append((h >> 40) % language.BUCKETS)
        out.append(sorted(grams))
    return out


def test_ngrams_against_a_plain_loop():
    texts = ["Hello, World!", "", "  a", "12 34", "é日本 🙂 x", "İstanbul", "...b..c"]
    got = [[] for _ in texts]
    for row, bucket in language.grams(texts):
        for i, b in zip(row, bucket):
            got[i].append(int(b))
    assert [sorted(x) for x in got] == naive(texts)


def test_slices_cover_long_texts(monkeypatch):
    text = "".join(random.Random(0).choice("abcde ") for _ in range(3000))
    whole = sorted(set(naive([text])[0]))
    monkeypatch.setattr(language, "SLICE", 100)
    assert set(whole) <= {int(b) for _, bucket in language.grams([text]) for b in bucket}


def test_predictions_against_a_plain_classifier(documents):
    """Counts, smoothing, prior and arg max one n-gram at a time, over the rows that may be learned from."""
    from math import exp, log, sqrt

    rows = corpus(120)
    counts, docs = {}, {}
    for i, t, lang in rows:
        if zlib.crc32(str(i).encode()) % 5:
            docs[lang] = docs.get(lang, 0) + 1
            for b in naive([t])[0]:
                counts.setdefault(lang, {})[b] = counts.setdefault(lang, {}).get(b, 0) + 1
    total = {x: sum(c.values()) + language.SMOOTH * language.BUCKETS for x, c in counts.items()}

    def said(lang, b):
        return log((counts[lang].get(b, 0) + language.SMOOTH) / total[lang])

    out = {r.doc_id: r for r in language.identify(documents(rows)).collect()}
    for i, t, _ in rows:
        grams = naive([t])[0]
        sums = {x: log(docs[x] / sum(docs.values())) + sum(said(x, b) for b in grams) for x in sorted(counts)}
        best = max(sums, key=sums.get)
        assert out[i].lang_pred == best
        assert abs(out[i].score - 1 / sum(exp(v - sums[best]) for v in sums.values())) < 1e-3
        zero = language.SMOOTH / total[best]
        p = [exp(said(best, b)) for b in counts[best]]
        rest = language.BUCKETS - len(p)
        mean = sum(x * log(x) for x in p) + rest * zero * log(zero)
        spread = sqrt(sum(x * log(x) ** 2 for x in p) + rest * zero * log(zero) ** 2 - mean ** 2)
        want = mean - sum(said(best, b) for b in grams) / len(grams) - language.SPREAD * spread / sqrt(len(grams))
        assert abs(out[i].surprise - want) < 1e-3


def test_edge_rows(documents):
    rows = [(*x, None) for x in EDGE] + corpus(60)
    rows = [(i if n < len(EDGE) else i + 1000, t, x) for n, (i, t, x) in enumerate(rows)] + [(None, "kato miru", "xx"), (2001, "123 !?", "xx")]
    out = language.identify(documents(rows, extra=True)).collect()
    assert len(out) == len(rows)
    unknown = {r.doc_id for r in out if r.lang_pred == "und"}
    assert unknown == {1, 2, 3, 2001} and {r.score for r in out if r.lang_pred == "und"} == {0.0}
    assert not [r for r in out if r.doc_id is None and r.held_out]
    none = language.identify(documents(EDGE)).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language.identify(documents([])).count() == 0
