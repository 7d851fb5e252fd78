import base64
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from llm_cases import EDGE
from tokenizers import Tokenizer

from ledgerloom.llm import alignment, common


def sides():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        bytes_a = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    return a, bytes_a, b, bytes_b


def brute(rows):
    """Token by token, each document on its own."""
    a, bytes_a, b, bytes_b = sides()
    aligned, counts = [], Counter()
    for i, t in rows:
        groups = []
        if t:
            x, y, whole = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t), (" " + t).encode()
            if b"".join(bytes_a[k] for k in x) == whole == b"".join(bytes_b(k) for k in y):
                left, right, na, nb, j = [], [], 0, 0, 0
                for k in x:
                    left.append(k)
                    na += len(bytes_a[k])
                    while j < len(y) and nb + len(bytes_b(y[j])) <= na:
                        nb += len(bytes_b(y[j]))
                        right.append(y[j])
                        j += 1
                    if na == nb:
                        groups.append((left, right))
                        left, right = [], []
        aligned.append((i, groups))
        counts.update((left[-1], right[-1]) for left, right in groups)
    high = {}
    for (_, y), c in counts.items():
        high[y] = max(high.get(y, 0), c)
    out = []
    for i, groups in aligned:
        links = [(x[-1], y[-1]) for x, y in groups]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(counts[k] == high[k[1]] for k in links), sum(counts[k] for k in links),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, alignment.alignment(df).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def corpus():
    r = random.Random(4)
    words = ["the", "tokenizer", "antidisestablishmentarianism", "Größe", "naïve", "日本語", "🙂", "x=1;", "\n\n", "   ", "\t", "don't",
             "<|endoftext|>", "</s>", "<unk>", "<0x0A>", "1234567", "¡hola!", "ﬁ", "é", " ", "　", "\x00", "\r\n"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 40)))) for i in range(120)]
    rows += [(200 + i, rows[5][1]) for i in range(60)] + [(300, "a▁b"), (301, "▁"), (302, "  two spaces"), (303, " ")]
    return rows


def test_against_brute_force(documents):
    rows = corpus()
    want = brute(rows)
    assert got(documents(rows).repartition(5)) == want
    assert sum(r[1] > 0 for r in want) > 150 and sum(r[1] == 0 for r in want) >= 2


def test_rare_texts_and_pairs_meet_in_a_shuffle(documents, monkeypatch):
    monkeypatch.setattr(common, "FREQUENT", 20)
    rows = corpus()
    assert got(documents(rows)) == brute(rows)


def test_edge_rows(documents):
    rows = [*EDGE, (11, "y" * 3000), (12, "é" * 5000)]
    assert got(documents(rows, extra=True)) == brute(rows)
    assert got(documents([])) == []
    assert got(documents([(1, None), (2, "")])) == brute([(1, None), (2, "")])


@pytest.mark.parametrize("size", [200_000, 1_000_000])
def test_long_texts_keep_every_byte(size):
    """Whole texts are aligned: the groups' tokens join to the text again."""
    r = random.Random(size)
    text = "".join(r.choice("abcdefgh ,.\n") for _ in range(size))
    both = alignment.aligner("byte_bpe_50k", "piece_bpe_32k")
    a, b, last_a, last_b = both.align(text)
    groups = both.groups(a, b, last_a, last_b).split(";")
    assert len(groups) == len(last_a) == len(last_b)
    for side, of in ((0, both.a), (1, both.b)):
        assert b"".join(of.bytes_of[int(i)] for g in groups for i in g.split("|")[side].split(",")) == (" " + text).encode()
