"""Exact top-k inner-product search by a uniform threshold in three phases.

A vector's score is the sum of partial scores over ``SLICES`` ranges of its
components; each range of each block of vectors holds one local score list.

1. Every list gives its k best entries for each query; their exact totals, over
   all blocks, give the k-th best, a cutoff that the true k-th cannot fall below.
2. The cutoff goes back to all blocks with the query block. A total can reach
   the cutoff only if one of its partial scores reaches the cutoff divided by
   the number of ranges, so only such entries are collected.
3. The remaining partial scores of the collected entries are resolved, and
   entries below the cutoff drop out; the k best by exact score remain.

Queries and vectors meet in blocks on a grid of (query block, group of vector
blocks), dealt out by both, so that neither side is ever in one task or on the
driver. Components are ``floor(64 * x)``; products are exact: in 32-bit floats
while they stay below 2^24, else in 64-bit floats below 2^53, else as integers.

Defined cases: a vector that is null or holds a null or non-finite component
takes no part, nor does one without an id; shorter vectors count as padded with
zeros; rows that share an id are rows of their own, and a query is compared
with all but its own row; ties go to the smaller id; scores beyond 64 bits are
held at the limit; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, ship

K = 20
SLICES = 2
BLOCK = 4096           # vectors in a block, and queries in a query block
GROUP = 4              # vector blocks that meet a query block in one cell of the grid
TILE = 512             # queries scored at once


def _packed(a) -> bytes:
    """A block's components in two, four or eight bytes each, the fewest that hold them; eight are floats."""
    import numpy as np

    top = np.abs(a).max(initial=0)
    return a.astype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8").tobytes()


def _unpacked(raw: bytes, dims: int, rows: int):
    import numpy as np

    return np.frombuffer(raw, {2: "<i2", 4: "<i4", 8: "<f8"}[len(raw) // max(1, dims * rows)]).reshape(-1, dims).astype(np.float64)


def _blocks(dims: int, block: int):
    """Vectors of a partition as blocks: ids and components in one row."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            for at in range(0, b.num_rows, block):
                chunk = b.slice(at, block)
                out = np.zeros((chunk.num_rows, dims))
                for i, v in enumerate(chunk.column(1)):
                    v = v.values.to_numpy(zero_copy_only=False)
                    out[i, :len(v)] = np.floor(64 * v.astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + k], pa.int64()), pa.array([chunk.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([_packed(out)], pa.binary())], ["block", "ids", "values"])
                k += 1

    return run


def _queries(dims: int, every: int):
    """The query rows of vector blocks, with the place of each row."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [(block, i, x, _packed(v[i]))
                    for block, ids, raw in zip(*(c.to_pylist() for c in b.columns))
                    for v in [_unpacked(raw, dims, len(ids))]
                    for i, x in enumerate(ids) if x % every == 0]
            cols = list(zip(*rows)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["own_block", "own_row", "query_id", "value"])

    return run


def _partials(q, v, slices: int):
    """The partial scores of each range of components; exact."""
    import numpy as np

    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]
    if top < 1 << 24:
        q, v = q.astype(np.float32), v.astype(np.float32)
    elif top >= 1 << 53:
        q, v = ([[int(x) for x in row] for row in a] for a in (q, v))
        q, v = np.array(q, object), np.array(v, object)
    cuts = np.linspace(0, q.shape[1], slices + 1).astype(int)
    return [q[:, a:b] @ v[:, a:b].T for a, b in zip(cuts, cuts[1:])]


def _tiles(dims: int, slices: int):
    """The pairs of a batch in tiles: ``(query block, places, ids, cutoffs, partial scores, vector ids, own row mask)``."""
    def tiles(batch):
        import numpy as np

        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
            block, vec_ids = row["block"].as_py(), np.array(row["ids"].as_py(), np.int64)
            v = _unpacked(row["values"].as_py(), dims, len(vec_ids))
            places, own, ids = row["places"].as_py(), row["own"].as_py(), row["query_ids"].as_py()
            q = np.concatenate([_unpacked(x, dims, 1) for x in row["queries"].as_py()])
            cut = row["cutoffs"].as_py() if "cutoffs" in row else None
            for a in range(0, len(q), TILE):
                rows = slice(a, a + TILE)
                partial = _partials(q[rows], v, slices)
                mine = [(n, o[1]) for n, o in enumerate(own[rows]) if o[0] == block]
                yield (row["qb"].as_py(), places[rows], ids[rows], cut and cut[rows], partial, vec_ids, mine)

    return tiles


def _totals(partial):
    total = partial[0].copy()
    for p in partial[1:]:
        total = total + p
    return total


def _gather(dims: int, slices: int, k: int):
    """Phase one: the exact totals of each list's best entries, the k best of a query and block."""
    tiles = _tiles(dims, slices)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for qb, places, _, _, partial, vec_ids, mine in tiles(batch):
                n, width = partial[0].shape
                best = np.zeros((n, width), bool)
                own = np.zeros((n, width), bool)
                for r, c in mine:
                    own[r, c] = True
                take = min(k + 1, width)       # one more: the query's own row does not count
                for p in partial:
                    at = np.argpartition(-p, take - 1, axis=1)[:, :take] if take < width else np.tile(np.arange(width), (n, 1))
                    np.put_along_axis(best, at, True, 1)
                best &= ~own
                r, c = np.nonzero(best)
                total = partial[0][r, c]
                for p in partial[1:]:
                    total = total + p[r, c]
                ends = np.searchsorted(r, np.arange(n + 1))
                lists = [sorted((int(x) for x in total[a:b]), reverse=True)[:k] for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([qb] * n, pa.int64()), pa.array(places, pa.int64()),
                     pa.array([[max(-(1 << 63), min(x, (1 << 63) - 1)) for x in y] for y in lists], pa.list_(pa.int64()))],
                    ["qb", "place", "totals"])

    return run


def _resolve(dims: int, slices: int, k: int):
    """Phases two and three: entries that may reach the cutoff, their exact scores, the k best of a query and block."""
    tiles = _tiles(dims, slices)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for qb, places, ids, cut, partial, vec_ids, mine in tiles(batch):
                known = np.array([c is not None for c in cut])
                least = np.array([c or 0 for c in cut], object if partial[0].dtype == object else np.float64)
                may = np.zeros(partial[0].shape, bool)
                for p in partial:
                    may |= p * slices >= least[:, None]
                may |= ~known[:, None]
                for r, c in mine:
                    may[r, c] = False
                r, c = np.nonzero(may)
                total = partial[0][r, c]
                for p in partial[1:]:
                    total = total + p[r, c]
                ok = (total >= least[r]) | ~known[r]
                r, c, total = r[ok], c[ok], total[ok]
                score = np.array([max(-(1 << 63), min(int(x), (1 << 63) - 1)) for x in total], np.int64)
                order = np.lexsort((vec_ids[c], ~score, r))
                r, c, score = r[order], c[order], score[order]
                first = np.searchsorted(r, r)
                few = np.arange(len(r)) - first < k
                r, c, score = r[few], c[few], score[few]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([qb] * len(r), pa.int64()), pa.array(np.array(places, np.int64)[r]),
                     pa.array(np.array(ids, np.int64)[r]), pa.array(vec_ids[c]), pa.array(score)],
                    ["qb", "place", "query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, every: int = 20, k: int = K, slices: int = SLICES, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows for each row whose id is divisible by ``every``."""
    ship(vectors.sparkSession)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    dims = max(1, rows.agg(F.max(F.size("embedding"))).first()[0] or 0)
    blocks = materialize(rows.mapInArrow(_blocks(dims, block), "block long, ids array<long>, values binary"), "topk-blocks")

    each = blocks.mapInArrow(_queries(dims, every), "own_block long, own_row long, query_id long, value binary")
    each = materialize(each, "topk-each")
    n_queries, n_blocks = each.count(), blocks.count()
    q_blocks, groups = max(1, -(-n_queries // block)), max(1, -(-n_blocks // GROUP))
    numbered = each.withColumn("qb", F.pmod(F.xxhash64("own_block", "own_row"), F.lit(q_blocks)))
    queries = numbered.groupBy("qb").agg(F.array_sort(F.collect_list(F.struct(
        "own_block", "own_row", "query_id", "value"))).alias("q"))
    queries = materialize(queries.select(
        "qb", F.sequence(F.lit(0).cast("long"), F.size("q").cast("long") - 1).alias("places"),
        F.transform("q", lambda x: F.array(x["own_block"], x["own_row"])).alias("own"),
        F.col("q.query_id").alias("query_ids"), F.col("q.value").alias("queries")), "topk-queries")

    cells = blocks.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))

    def meet(queries):
        spread = queries.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        return cells.join(spread, ["qb", "g"]).drop("g")

    lists = meet(queries).mapInArrow(_gather(dims, slices, k), "qb long, place long, totals array<long>")
    totals = lists.select("qb", "place", F.explode("totals").alias("total"))
    nth = F.row_number().over(Window.partitionBy("qb", "place").orderBy(F.desc("total")))
    cutoffs = totals.withColumn("nth", nth).where(F.col("nth") <= k).where(F.col("nth") == k).select("qb", "place", "total")
    cutoffs = materialize(cutoffs, "topk-cutoffs").groupBy("qb").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "total"))).alias("cut"))      # at most a block of queries
    aware = queries.join(cutoffs, "qb", "left").withColumn(
        "cutoffs", F.transform("places", lambda p: F.col("cut")[p])).drop("cut")
    found = meet(materialize(aware, "topk-aware")).mapInArrow(
        _resolve(dims, slices, k), "qb long, place long, query_id long, vec_id long, score long")
    best = Window.partitionBy("qb", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
