import zlib

import numpy as np
import pytest
from llm_cases import EDGE

from ledgerloom.llm import packing

pytest.importorskip("public_tokenizers")


def reference(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


TRICKY = ["", " ", "a", "it's I'LL don't' s", "tabs\tand  double  spaces \n\n new", "nbsp\xa0here wide", "12 345 a1b2",
          "café déjà – “quoted” … ok", "日本語 と 한국어", "🙂👍🏽 x", "<|endoftext|> inside", "x" * 5000, "ab " * 3000, "́́e",
          "ﬁ ligature ǅ ʰ", "١٢٣ ४५", "\r\n\r\n", "a' b' c", "'s 's", "\x00\x01"]


def test_ids_equal_the_tokenizers_library():
    encode = packing.encoder("byte_bpe_50k")
    assert [encode(t) + [1] for t in TRICKY] == reference(TRICKY)


def test_slices_cut_only_where_no_token_crosses(monkeypatch):
    import random

    r = random.Random(5)
    text = "".join(r.choice(["the ", "don't ", "  ", "\n", "ab", "12", " é", ", ", "' "]) for _ in range(4000))
    assert "".join(packing.slices(text, 50)) == text
    whole = reference([text])[0]
    parts = [i for p in packing.slices(text, 50) for i in reference([p])[0][:-1]]
    assert parts + [1] == whole


def check(docs, length=64):
    out = packing.pack(docs, length=length, with_ids=True).toPandas().sort_values(["sequence_id", "offset"])
    # gapless: each sequence but the last is full
    flat = 0
    for seq, off, n in zip(out.sequence_id, out.offset, out.length):
        assert seq * length + off == flat and 0 < n <= length - off
        flat += n
    for crc, ids in zip(out.ids_crc32, out.ids):
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
    return out


def test_pieces_rebuild_every_document(documents):
    rows = [(i, t) for i, t in enumerate(TRICKY)]
    out = check(documents(rows))
    want = reference(TRICKY)
    for i, ids in enumerate(want):
        got = out[out.doc_id == i].sort_values("start")
        assert [x for p in got.ids for x in p] == ids
        assert set(got.doc_tokens) == {len(ids)} and list(got.start) == list(np.cumsum([0, *got.length[:-1]]))


def test_edge_rows_and_extra_columns(documents):
    out = check(documents(EDGE, extra=True))
    assert out.length.sum() == sum(map(len, reference([t for _, t in EDGE])))
    assert (out[out.doc_id == 4].start == 0).sum() == 2           # repeated rows stay


def test_empty_table(documents):
    assert packing.pack(documents([])).count() == 0


def test_sequences_are_padded_except_at_a_power_of_two(documents):
    pieces = packing.pack(documents([(1, "one two three four five six")]), length=4, with_ids=True)
    rows = packing.sequences(pieces, length=4, pad=9).orderBy("sequence_id").collect()
    assert [len(r.ids) for r in rows[:-1]] == [4] * (len(rows) - 1)
    assert len(rows[-1].ids) == (rows[-1].n if rows[-1].n in (1, 2, 4) else 4)
