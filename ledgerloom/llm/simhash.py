"""SimHash near-duplicates by tiled exact comparison.

Every document gets a 64-bit fingerprint. Distinct fingerprints are laid out in
tiles by the population counts of their four 16-bit quarters. The sum of the
absolute differences of those counts is a lower bound of the bit distance, so
a tile is compared only with the tiles within ``radius`` of it; all others are
skipped without loss. Inside a pair of tiles numpy compares everything with
exclusive-or and bit counts. Links are exact: no banding, no sampling, no caps.

Defined cases: null or blank text has no words and fingerprint zero, linked like
any other; fewer than ``width`` words make one shingle; repeated rows stay
separate rows with equal results; a null ``doc_id`` takes part but never names
a component unless every member's id is null (then it is null); an empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, discard, materialize, ship

SEED = 42                 # of XXH64
SLICE_BYTES = 1 << 20     # a long text is hashed in slices of about this size
BLOCK = 2048              # fingerprints in one side of a compared pair


def _shingle_hashes(text: bytes, width: int):
    """XXH64 of each word shingle, slice by slice, so that memory stays bounded for any length."""
    import numpy as np
    import xxhash

    digest, tail, at, seen = xxhash.xxh64_intdigest, [], 0, 0
    while at < len(text):
        end = min(len(text), at + SLICE_BYTES)
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = tail + text[at:end].lower().split()
        at = end
        n = len(words) - width + 1
        if n > 0:
            seen += n
            yield np.fromiter((digest(b" ".join(words[i:i + width]), SEED) for i in range(n)), np.uint64, n)
            tail = words[n:]
        else:
            tail = words
    if not seen and tail:
        yield np.array([digest(b" ".join(tail), SEED)], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of one text: a bit is set where over half of the shingle hashes have it."""
    import numpy as np

    ones, n = np.zeros(64, np.int64), 0
    for h in _shingle_hashes((text or "").encode("utf-8", "surrogatepass"), width):
        for part in np.array_split(h, max(1, len(h) // 65536)):
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
        n += len(h)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > n))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``docs`` with ``text`` replaced by ``fp``, the fingerprint of every row as a signed 64-bit number."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != "text"]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fp = [fingerprint(t.as_py(), width) for t in b.column(len(rest))]
            fp = pa.array([x - (1 << 64) if x >> 63 else x for x in fp], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], fp], [*rest, "fp"])

    kinds = dict(docs.dtypes)
    return docs.select(*rest, "text").mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in rest] + ["fp long"]))


def _quarter(i: int):
    return F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)))


def _links(radius: int):
    """Compare pairs of blocks; yields a spanning set of the links of each pair."""
    def spanning(m, a, b):
        import numpy as np

        i, j = np.nonzero(m)
        if len(i) <= len(a) + len(b):
            return a[i], b[j]
        # many links in one pair of blocks: keep one star for each connected group
        rows, left, right = m.any(1), [], []
        while rows.any():
            r = int(np.argmax(rows))
            cols, mine = m[r], np.zeros(len(a), bool)
            while True:
                grown = m[:, cols].any(1)
                if (grown == mine).all():
                    break
                mine, cols = grown, m[grown].any(0)
            rows &= ~mine
            at = int(np.argmax(cols))
            left += [a[mine], np.full(int(cols.sum()), a[r])]
            right += [np.full(int(mine.sum()), b[at]), b[cols]]
        return np.concatenate(left), np.concatenate(right)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def values(column, i):
            return column[i].values.to_numpy(zero_copy_only=False).view(np.uint64)

        for batch in batches:
            left, right = [], []
            for i in range(batch.num_rows):
                a, b = values(batch.column(0), i), values(batch.column(1), i)
                m = np.empty((len(a), len(b)), bool)
                for k in range(0, len(a), 128):
                    m[k:k + 128] = np.bitwise_count(a[k:k + 128, None] ^ b[None, :]) <= radius
                if m.any():
                    x, y = spanning(m, a, b)
                    left.append(x[x != y])
                    right.append(y[x != y])
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v).view(np.int64)) for v in (left, right)], ["a", "b"])

    return run


def links(distinct: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints of ``distinct(fp)`` within ``radius`` bits of each other.

    Within one pair of blocks a large group is reduced to a spanning star; the
    connected components are those of all links.
    """
    q = [F.col(f"p{i}") for i in range(4)]
    code = ((q[0] * 17 + q[1]) * 17 + q[2]) * 17 + q[3]
    fps = distinct.select("fp", *[_quarter(i).alias(f"p{i}") for i in range(4)]).withColumn("tile", code)
    # at most 17^4 = 83,521 tiles whatever the input: safe to broadcast
    sizes = fps.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("subs"))
    sizes = F.broadcast(materialize(sizes, "simhash-tiles"))
    blocks = materialize(
        fps.join(sizes, "tile").withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
        .groupBy("tile", "sub").agg(F.collect_list("fp").alias("fps"), *[F.first(f"p{i}").alias(f"p{i}") for i in range(4)]),
        "simhash-blocks")
    near = [d for d in itertools.product(range(-radius, radius + 1), repeat=4)
            if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]      # each pair of tiles once
    steps = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(d)]) for d in near])
    # the smaller table of pairs is built first, without the fingerprints
    moved = blocks.select("tile", "sub", *[f"p{i}" for i in range(4)], F.explode(steps).alias("d"))
    moved = moved.select(F.col("tile").alias("tile_a"), F.col("sub").alias("sub_a"),
                         *[(F.col(f"p{i}") + F.col(f"d.d{i}")).alias(f"p{i}") for i in range(4)])
    moved = moved.where(" AND ".join(f"p{i} BETWEEN 0 AND 16" for i in range(4)))
    pairs = (moved.withColumn("tile", code).join(sizes, "tile")
             .select("tile_a", "sub_a", F.col("tile").alias("tile_b"),
                     F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub_b"))
             .where("tile_a <> tile_b OR sub_a <= sub_b"))
    a = blocks.select(F.col("tile").alias("tile_a"), F.col("sub").alias("sub_a"), F.col("fps").alias("fa"))
    b = blocks.select(F.col("tile").alias("tile_b"), F.col("sub").alias("sub_b"), F.col("fps").alias("fb"))
    both = pairs.join(a, ["tile_a", "sub_a"]).join(b, ["tile_b", "sub_b"]).select("fa", "fb")
    return both.mapInArrow(_links(radius), "a long, b long")


def _grouped(each: DataFrame, radius: int) -> DataFrame:
    """``(fp, root)``: the group of every fingerprint of ``each``."""
    distinct = materialize(each.select("fp").distinct(), "simhash-distinct")
    roots = components(links(distinct, radius), "simhash-cc").withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``.

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked;
    ``component_id`` is the smallest ``doc_id`` that links lead to.
    """
    each = materialize(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), width),
                       "simhash-fp")
    named = _grouped(each, radius).join(each.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fp", "left")
    named = materialize(named, "simhash-named")
    firsts = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = named.join(firsts, "root").select("fp", "component_id")
    return each.join(names, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One document of each group, whole: the smallest ``doc_id`` (nulls last).

    Where rows repeat that id, the one with the smallest hash of its columns
    stays; of rows equal in every column, one.
    """
    cols = docs.columns
    keyed = docs.withColumn("_ll_row", F.xxhash64(*[F.col(f"`{c}`") for c in cols]))
    each = materialize(fingerprints(keyed.select("doc_id", "_ll_row", "text"), width), "simhash-fp")
    groups = materialize(_grouped(each, radius), "simhash-groups")
    firsts = (each.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_ll_row")).alias("k"))
              .join(groups, "fp").groupBy("root").agg(F.min("k").alias("k")).select("k.doc_id", "k._ll_row"))
    firsts = materialize(firsts, "simhash-firsts")

    def semi(how, left, right):
        return left.join(right, left["doc_id"].eqNullSafe(right["doc_id"]) & (left["_ll_row"] == right["_ll_row"]), how)

    kept = semi("left_semi", keyed, firsts)
    again = materialize(semi("left_semi", each.groupBy("doc_id", "_ll_row").agg(F.count(F.lit(1)).alias("n"))
                             .where("n > 1"), firsts), "simhash-again")
    if not again.isEmpty():       # fully equal rows among those kept: one of each
        kept = semi("left_anti", kept, again).unionByName(semi("left_semi", kept, again).dropDuplicates(["doc_id", "_ll_row"]))
    return kept.select(*[F.col(f"`{c}`") for c in cols])
