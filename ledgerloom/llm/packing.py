"""Concatenate-and-cut packing of documents into fixed token windows.

All documents form one stream of token ids, each ended by a separator. Pass one
encodes every partition in place, noting each document's offset in its
partition and writing ids to the shared folder. Prefix sums over the
partitions' totals, one row a partition, turn these into global offsets. Pass
two cuts at every multiple of the window length: a document that crosses a
boundary gives a record on each side. Nothing is shuffled but the totals, and
no padding arises except in the last window.

Defined cases: null and empty texts hold only the separator; rows are packed as
they come, repeated or not, ids null or not; a text of any length is encoded in
slices cut where no token can cross; an empty table gives no pieces. Extra
columns are ignored.

Ids are those of ``tokenizers`` with the given vocabulary file. For texts of
ASCII, Latin and common punctuation only, where both libraries' patterns agree,
they are computed by ``tiktoken`` from the same vocabulary as ranks, which takes
a fifth of the time; any other text goes through ``tokenizers`` itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, ship

LENGTH = 2048
SEPARATOR = 1
SLICE = 1 << 18                # characters encoded at once
BROADCAST_ROWS = 1_000_000     # partitions: 16 bytes each
COMMON = re.compile("[\x00-ɏ‐-‧]*")
LONG_RUN = re.compile(r"\S{2000}")
#: A place where a token cannot cross: a single space between characters that are not space.
SAFE_CUT = re.compile(r"(?<=[^\s'])(?= [^\s])")


def slices(text: str, size: int = SLICE):
    """Cut a long text at spaces that always begin a token."""
    at = 0
    while len(text) - at > size:
        m = SAFE_CUT.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


_ENCODERS: dict = {}


def encoder(name: str):
    """A function from a text to the list of its ids; one for each worker process and vocabulary."""
    if name not in _ENCODERS:
        import base64
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        special = [t.content for t in whole.get_added_tokens_decoder().values()]

        def encode(text: str) -> list[int]:
            ids: list[int] = []
            for part in slices(text):
                if COMMON.fullmatch(part) and not any(s in part for s in special) and not LONG_RUN.search(part):
                    ids += fast.encode_ordinary(part)
                else:
                    ids += whole.encode(part, add_special_tokens=False).ids
            return ids

        _ENCODERS[name] = encode
    return _ENCODERS[name]


def _encoded(name: str, separator: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, part, at = encoder(name), TaskContext.get().partitionId(), 0
        for b in batches:
            for k in range(0, b.num_rows, 512):
                ids, starts, counts = [], [], []
                chunk = b.slice(k, 512)
                for t in chunk.column(1):
                    x = np.array([*encode(t.as_py() or ""), separator], "<u4")
                    # two bytes an id where they suffice
                    ids.append((x.astype("<u2") if x.max() < 1 << 16 else x).tobytes())
                    starts.append(at)
                    counts.append(len(x))
                    at += len(x)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), pa.array([part] * len(ids), pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "part", "at", "n", "ids"])

    return run


def _cut(length: int, with_ids: bool):
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        for b in batches:
            rows = [[] for _ in names]
            for doc, at, n, raw in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    take = min(n - start, length - offset)
                    piece = ids[start:start + take]
                    out = [doc, start, take, zlib.crc32(piece.tobytes()), n, sequence, offset]
                    for column, v in zip(rows, out + [piece.tolist()] * with_ids):
                        column.append(v)
                    start += take
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    return run


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = "byte_bpe_50k", separator: int = SEPARATOR,
         with_ids: bool = False) -> DataFrame:
    """One row for each piece: the document, the piece's start and length in it, the CRC-32 of its ids, the
    document's token count, and the piece's sequence and offset there (``with_ids``: the ids as well)."""
    ship(docs.sparkSession)
    encoded = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _encoded(vocabulary, separator), "doc_id long, part long, at long, n long, ids binary"), "packing-ids")
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total"))     # one row for each partition
    base = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    bases = materialize(totals.select("part", base.alias("base")), "packing-offsets")
    if bases.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = encoded.join(bases, "part").select("doc_id", (F.col("base") + F.col("at")).alias("at"), "n", "ids")
    return placed.mapInArrow(_cut(length, with_ids), "doc_id long, start long, length long, ids_crc32 long, "
                             "doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids)


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """``(sequence_id, n, ids)`` from pieces with ids: padded to ``length``, unless ``n`` is a power of two.

    A group holds at most ``length`` tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    fill = F.array_repeat(F.lit(pad), length - n)
    return whole.select("sequence_id", n.alias("n"),
                        F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(F.concat("ids", fill)).alias("ids"))
