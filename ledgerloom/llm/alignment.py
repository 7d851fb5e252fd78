"""Alignment of two tokenizers' tokens over a corpus, with exact-text deduplication.

The corpus is shuffled by full text, with a count of the copies made before the shuffle, so that each distinct text
is tokenised and aligned once, however many documents hold it. Tokenizer A encodes a space and the text, tokenizer B
the text, before which it sets a space itself. Byte offsets where tokens of both end cut the text into groups; the
two tokens that end there are linked. Counts of linked id pairs over the corpus are sums over the distinct texts,
weighted by their copies; measures of a text are joined back to the ``doc_id`` of each of its documents.

A document meets its text by the text's SHA-256. Texts with many copies, and id pairs that many texts hold, are
broadcast, at most ``FREQUENT`` of them; all others meet in a shuffle in which no key is large.

Defined cases: null and empty texts, and texts whose tokens do not join to the text's own bytes (B reads U+2581 as a
space, for one), have no tokens: zeros and an empty digest; special tokens' strings are plain text; ids tied for the
highest count all count as best; repeated rows and null ids give a row each; a text of any length is aligned whole,
by one task; an empty table has no rows. Extra columns are ignored.

A's ids are computed as in :mod:`ledgerloom.llm.packing`, by ``tiktoken`` where both libraries agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_by_frequency, materialize, ship
from ledgerloom.llm.packing import COMMON, LONG_RUN, slices

ALIGNED = ("key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<long>")

_PAIRS: dict = {}


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from U+0100 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """One tokenizer: how it encodes a text, and the bytes and the decimal form of each id."""

    def __init__(self, encode, bytes_of):
        import numpy as np

        self.encode, self.bytes_of = encode, bytes_of
        self.length = np.array([len(b) for b in bytes_of], np.int64)


def _byte_level(name: str) -> Side:
    import base64
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    whole.encode_special_tokens = True         # their strings are plain text
    alphabet, special = _byte_alphabet(), {t.content for t in whole.get_added_tokens_decoder().values()}
    entries = [whole.id_to_token(i) for i in range(whole.get_vocab_size())]
    bytes_of = [t.encode() if t in special else bytes(alphabet[c] for c in t) for t in entries]
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        ids: list[int] = []
        for part in slices(" " + text):
            if COMMON.fullmatch(part) and not LONG_RUN.search(part):
                ids += fast.encode_ordinary(part)
            else:
                ids += whole.encode(part, add_special_tokens=False).ids
        return ids

    return Side(encode, bytes_of)


def _pieces(name: str) -> Side:
    import re

    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))

    def plain(i: int) -> bytes:
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if model.is_byte(i) else None
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    return Side(lambda text: model.encode(text, num_threads=1), [plain(i) for i in range(model.get_piece_size())])


class Aligner:
    """Aligns single texts; one for each worker process and pair of vocabularies."""

    def __init__(self, a: str, b: str):
        self.a, self.b = _byte_level(a), _pieces(b)
        self.base = len(self.a.bytes_of)
        # an id as it stands in the digest: followed by another of its run, or last of it
        self.said = [f"{i}," for i in range(self.base)] + [f"{i}," for i in range(len(self.b.bytes_of))]
        self.said += [f"{i}|" for i in range(self.base)] + [f"{i};" for i in range(len(self.b.bytes_of))]

    def align(self, text: str):
        """``(ids of A, ids of B, ends)`` with the byte offsets where both end, or None where a text has no tokens."""
        import numpy as np

        whole = (" " + text).encode()
        ids_a, ids_b = self.a.encode(text), self.b.encode(text)
        if b"".join(map(self.a.bytes_of.__getitem__, ids_a)) != whole or b"".join(map(self.b.bytes_of.__getitem__, ids_b)) != whole:
            return None
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = self.a.length[a].cumsum(), self.b.length[b].cumsum()
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        return a, b, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)

    def groups(self, a, b, last_a, last_b) -> str:
        """``a1,a2|b1;a3|b2,b3``."""
        import numpy as np

        groups = np.arange(len(last_a))
        runs_a, runs_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        # each group's ids of A stand behind all ids of B before it, and its ids of B behind its ids of A
        at_a = np.arange(len(a)) + np.repeat(last_b - runs_b + 1, runs_a)
        at_b = np.arange(len(b)) + np.repeat(last_a + 1, runs_b)
        code = np.empty(len(a) + len(b), np.int64)
        code[at_a], code[at_b] = a, b + self.base
        code[at_a[last_a[groups]]] += len(self.said) // 2
        code[at_b[last_b[groups]]] += len(self.said) // 2
        return "".join(map(self.said.__getitem__, code.tolist()))[:-1]


def aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _PAIRS:
        _PAIRS[a, b] = Aligner(a, b)
    return _PAIRS[a, b]


def _aligned(a: str, b: str):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ALIGNED.split(", "))])
        both = aligner(a, b)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                chunk = batch.slice(k, 256)
                columns = [[] for _ in schema]
                for key, text, copies in zip(*(c.to_pylist() for c in chunk.columns)):
                    found = both.align(text)
                    if found is None:
                        row = (key, copies, 0, 0, 0, 0, "", [], [])
                    else:
                        ids_a, ids_b, last_a, last_b = found
                        said = both.groups(*found).encode()
                        pairs, times = np.unique(ids_a[last_a] << 32 | ids_b[last_b], return_counts=True)
                        row = (key, copies, len(ids_a), len(ids_b), len(last_a), len(last_a),
                               hashlib.sha256(said).hexdigest(), pairs, times)
                    for column, v in zip(columns, row):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def aligned_texts(docs: DataFrame, a: str = "byte_bpe_50k", b: str = "piece_bpe_32k") -> DataFrame:
    """One row for each distinct text that is neither null nor empty: ``key`` (its SHA-256), ``copies``, its numbers of
    tokens, groups and links, the digest of its groups, and its linked id ``pairs`` with the ``times`` each occurs.
    A pair is A's id, shifted by 32 bits, and B's."""
    ship(docs.sparkSession)
    texts = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.select(F.sha2(F.col("text").cast("binary"), 256).alias("key"), "text", "copies")
    return materialize(texts.mapInArrow(_aligned(a, b), ALIGNED), "align-texts")


def pair_counts(texts: DataFrame) -> DataFrame:
    """``(pair, count, texts, best)`` over the corpus: how many links hold the pair, how many distinct texts do, and
    whether no pair of the same id of B has a higher count."""
    rows = texts.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = rows.groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum(F.col("copies") * F.col("p.times")).alias("count"), F.count(F.lit(1)).alias("texts"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "align-pairs")
    high = counts.groupBy("b").agg(F.max("count").alias("high"))          # one row for each id of B
    counts = counts.join(high, "b").select("pair", "count", "texts", (F.col("count") == F.col("high")).alias("best"))
    return materialize(counts, "align-counts")


def alignment(docs: DataFrame, a: str = "byte_bpe_50k", b: str = "piece_bpe_32k") -> DataFrame:
    """One row a document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    texts = aligned_texts(docs, a, b)
    held = texts.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "key", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    linked = join_by_frequency(held, pair_counts(texts), "pair", "texts")
    sums = linked.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                     F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    measures = texts.drop("pairs", "times").join(sums, "key", "left").select(
        "key", "copies", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in columns], "groups_sha256")
    measures = materialize(measures, "align-measures")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = ids.where("text <> ''").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("key"))
    out = join_by_frequency(keyed, measures, "key", "copies").select("doc_id", *columns, "groups_sha256")
    none = ids.where("text IS NULL OR text = ''").select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in columns], F.lit("").alias("groups_sha256"))
    return out.unionByName(none)
