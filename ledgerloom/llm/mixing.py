"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree over blocks.

Each source's documents are dealt into blocks of about ``BLOCK`` words by a hash of id and text. A source's target,
in words, becomes whole passes over its blocks (epochs) and a last, partial one over a prefix of its permuted blocks,
whose final block is cut inside a document: the source's words come to the rounded target exactly.

The draws, one for each block of each pass, are dealt to output shards of fixed numbers of blocks. A node of the
splitting tree holds a range of shards and, for each source, how many draws the range gets; its lower half of the
shards gets a multivariate-hypergeometric sample of them, its upper half the rest. A leaf is one shard with its exact
quota of every source, and with where its quota begins in the source's permuted blocks, so that shards draw disjoint
blocks without knowing of each other. A node's random numbers depend on the seed and its range alone. Nodes are rows:
each round of the tree splits all of them ten levels further, in parallel. Inside a shard documents are put in the
order of a hash.

Everything per document is a join on its block; of rows of a source only sums are gathered. Sources are rows of a
table, one each; a node of the tree has one number for each source, and the two running sums over sources that give
targets pass through one task, of some 50 bytes a source.

Defined cases: a null text has size 0; a null source is a source of its own, after all others; documents without
words take no part (``taken`` 0); a source without words has target 0 and its weight goes to the others; repeated
rows are told apart only by their order in a block's cut, and a null ``doc_id`` hashes as such; texts of any length
count whole, and one longer than a block makes its block longer; an empty table has no rows. Extra columns are kept
by :func:`mix`, and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_by_frequency, materialize, ranked, ship

WEIGHTS = (5, 2, 1)
REPEATS = 3                    # passes over a source at most
BLOCK = 1 << 16                # words
BLOCK_ROWS = 1 << 16
SHARD = 64                     # blocks
MOST_BLOCKS = 100_000_000      # in all: numpy's sampler takes fewer than 10**9; larger corpora get longer blocks
CHUNK = 4096                   # blocks summed together in the first of two running sums
LEVELS = 10                    # of the tree, in one round
SEED = 12
WORD = r"[^\x20\x09-\x0D]+"
#: Primes above any number of blocks: multiplying by one permutes the blocks of a source, in another way each pass.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579)


def _numbered(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """``rows`` with ``copy``, a number that tells rows equal in ``by`` apart."""
    if rows.groupBy(*by).count().where("count > 1").isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    return ranked(rows, by, [], label, groups=False).withColumnRenamed("rank", "copy").drop("size", "grp")


def _sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, body, copy, source, w)``: of every document the hash of its text and its words, written."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                                    F.xxhash64("text").alias("body"), words.alias("w")), "mix-sizes")
    return _numbered(sized, ["doc_id", "body"], "mix-copies")


def targets(sized: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``(source, src, source_rows, source_size, target)`` for every source.

    Sources below the water level get their weight's share; those whose share would pass ``repeats`` times their size
    get that, and the rest share again: with sources in the order of size by weight, a running sum finds the level.
    """
    sums = materialize(sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("source_rows"), F.sum("w").alias("source_size")), "mix-sources")
    order = sums.withColumn("known", F.when(F.col("source").isNull(), 1).otherwise(0))
    order = ranked(order, [], ["known", "source"], "mix-sources").withColumnRenamed("rank", "src").drop("known", "size", "grp")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    fill = order.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(repeats))
    one = Window.partitionBy(F.lit(0))
    upto = one.orderBy(F.col("cap") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    after = one.orderBy((F.col("cap") / F.col("weight")).desc(), F.col("src").desc()).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("source_size").over(one)
    # the level if all sources before this one are full
    level = (total - F.coalesce(F.sum("cap").over(upto), F.lit(0))) / F.sum("weight").over(after)
    fill = fill.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    by_ratio = F.struct((F.col("cap") / F.col("weight")).alias("ratio"), "src", "level")
    water = F.min(F.when(~F.col("full"), by_ratio)).over(one)["level"]
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(water * F.col("weight"))
    return materialize(fill.select("source", "src", "source_rows", "source_size", target.alias("target")), "mix-targets")


def _blocks_of(sources: DataFrame) -> DataFrame:
    """Columns ``blocks``, ``want`` (the target in words), ``passes`` (whole ones) and ``rest``, words of the last one."""
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    block = max(BLOCK, -(-words // MOST_BLOCKS))
    blocks = F.greatest(F.ceil(F.col("source_size") / block), F.ceil(F.col("source_rows") / BLOCK_ROWS), F.lit(1))
    want = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * REPEATS)
    out = sources.withColumn("blocks", blocks.cast("long")).withColumn("want", want.cast("long"))
    whole = F.when(F.col("source_size") > 0, F.expr("want div source_size")).otherwise(0)
    return out.withColumn("passes", whole.cast("long")).withColumn("rest", F.col("want") - F.col("passes") * F.col("source_size"))


def _permuted(position, n, src, epoch):
    """The block at a position of a source's pass."""
    prime = F.element_at(F.array(*[F.lit(p) for p in PRIMES]), (epoch + 1).cast("int"))
    shift = F.pmod(F.xxhash64(F.lit(SEED), src, epoch), n)
    return F.pmod(position * F.pmod(prime, n) + shift, n)


def _last_pass(sources: DataFrame, words: DataFrame) -> DataFrame:
    """``(src, drawn, cut)``: how many permuted blocks the last pass draws, and the words taken of the last of them."""
    places = sources.where("rest > 0").select("src", "blocks", "rest", "passes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("at"))
    places = places.withColumn("block", _permuted(F.col("at"), F.col("blocks"), F.col("src"), F.col("passes")))
    held = materialize(places.join(words, ["src", "block"], "left").select(
        "src", "at", "rest", F.coalesce("words", F.lit(0)).alias("words"), F.expr(f"at div {CHUNK}").alias("chunk")), "mix-places")
    # two running sums, so that no window holds all blocks of a source
    chunks = held.groupBy("src", "chunk").agg(F.sum("words").alias("w"))
    chunks = chunks.select("src", "chunk", (F.sum("w").over(Window.partitionBy("src").orderBy("chunk")) - F.col("w")).alias("base"))
    inside = F.sum("words").over(Window.partitionBy("src", "chunk").orderBy("at"))
    before = held.join(chunks, ["src", "chunk"]).withColumn("before", F.col("base") + inside - F.col("words"))
    last = F.max(F.struct("at", (F.col("rest") - F.col("before")).alias("cut")))
    return before.where("before < rest AND words > 0").groupBy("src").agg(last.alias("m")).select(
        "src", (F.col("m.at") + 1).alias("drawn"), "m.cut")


NODE = "lo long, hi long, draws array<long>, begins array<long>"


def _split(total: int, shards: int, seed: int, levels: int):
    """Splits nodes until they are single shards, or ``levels`` further."""
    def share(shard: int) -> int:
        return total * shard // shards            # draws of all shards before

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for row in b.to_pylist():
                todo, out = [(row["lo"], row["hi"], np.array(row["draws"], np.int64), np.array(row["begins"], np.int64), 0)], []
                while todo:
                    lo, hi, draws, begins, depth = todo.pop()
                    if hi - lo == 1 or depth == levels:
                        out.append((lo, hi, draws, begins))
                        continue
                    mid = (lo + hi) // 2
                    random = np.random.Generator(np.random.PCG64([seed, lo, hi]))
                    low = random.multivariate_hypergeometric(draws, share(mid) - share(lo), method="marginals")
                    todo.append((mid, hi, draws - low, begins + low, depth + 1))
                    todo.append((lo, mid, low, begins, depth + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                    ["lo", "hi", "draws", "begins"])

    return run


def shard_quotas(draws: DataFrame, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``(shard, src, begin, quota)`` from ``(src, draws)``, one row a source: a shard's draws are those from ``begin`` on."""
    ship(draws.sparkSession)
    total = draws.agg(F.sum("draws")).first()[0] or 0
    shards = max(1, -(-total // shard))
    every = F.array_sort(F.collect_list(F.struct("src", "draws")))
    nodes = draws.agg(every.alias("s")).where("size(s) > 0").select(
        F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), F.col("s.draws").alias("draws"),
        F.transform("s", lambda _: F.lit(0).cast("long")).alias("begins"), F.col("s.src").alias("names"))
    names = materialize(nodes.select("names"), "mix-names")
    nodes, span = nodes.drop("names"), shards
    while True:
        nodes = materialize(nodes.mapInArrow(_split(total, shards, seed, LEVELS), NODE), "mix-tree")
        span = -(-span // (1 << LEVELS))
        if span <= 1:
            break
        nodes = nodes.repartitionByRange("lo")
    each = nodes.select(F.col("lo").alias("shard"), F.posexplode(F.arrays_zip("begins", "draws")).alias("nth", "q"))
    order = names.select(F.posexplode("names").alias("nth", "src"))
    return each.where("q.draws > 0").join(order, "nth").select(
        "shard", "src", F.col("q.begins").alias("begin"), F.col("q.draws").alias("quota"))


def plan(docs: DataFrame) -> DataFrame:
    """``(doc_id, body, copy, size, source_size, target, draws)`` of every document; ``draws`` lists the ``epoch``,
    ``shard`` and ``words`` of each time that it is taken, at least in part. Written."""
    sized = _sized(docs)
    sources = materialize(_blocks_of(targets(sized)), "mix-sources")
    name = F.sha2(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")), 256)
    keys = sources.withColumn("name", name).drop("source")
    block = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", F.col("doc_id").isNull(), "body", "copy"), F.col("blocks"))
    placed = join_by_frequency(sized.withColumn("name", name), keys, "name", "source_rows").withColumn("block", block)
    placed = materialize(placed.select("doc_id", "body", "copy", F.col("w").alias("size"), "source_size", "target", "src", "block"),
                         "mix-documents")
    words = materialize(placed.where("size > 0").groupBy("src", "block").agg(F.sum("size").alias("words")), "mix-words")
    last = materialize(_last_pass(sources, words), "mix-last")

    drawn = sources.join(last, "src", "left").select(
        "src", "blocks", "passes", (F.col("passes") * F.col("blocks") + F.coalesce("drawn", F.lit(0))).alias("draws"), "cut")
    drawn = materialize(drawn.where("draws > 0"), "mix-draws")
    each = shard_quotas(drawn.select("src", "draws"), SHARD).join(drawn, "src").select(
        "shard", "src", "blocks", "passes", "draws", "cut",
        F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("quota") - 1)).alias("nth"))
    each = each.withColumn("epoch", F.expr("nth div blocks"))
    at = _permuted(F.col("nth") % F.col("blocks"), F.col("blocks"), F.col("src"), F.col("epoch"))
    limit = F.when((F.col("nth") == F.col("draws") - 1) & (F.col("epoch") == F.col("passes")), F.col("cut"))
    blocks = each.select("src", at.alias("block"), F.struct("epoch", "shard", limit.alias("limit")).alias("draw"))
    blocks = blocks.groupBy("src", "block").agg(F.array_sort(F.collect_list("draw")).alias("drawn"))    # REPEATS at most
    joined = materialize(placed.join(materialize(blocks, "mix-blocks"), ["src", "block"], "left"), "mix-joined")

    # in the one block of a source that is cut, the words of the documents before
    is_cut = F.coalesce(F.exists("drawn", lambda d: d["limit"].isNotNull()), F.lit(False)) & (F.col("size") > 0)
    order = Window.partitionBy("src", "block").orderBy(F.xxhash64("body", "doc_id", "copy"), "doc_id", "body", "copy")
    cut = joined.where(is_cut).withColumn("before", F.sum("size").over(order) - F.col("size"))
    joined = joined.where(~is_cut).withColumn("before", F.lit(0).cast("long")).unionByName(cut)

    def taken_of(d):
        part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), d["limit"] - F.col("before")))
        return F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"),
                        F.when(d["limit"].isNull(), F.col("size")).otherwise(part).alias("words"))

    draws = F.filter(F.transform("drawn", taken_of), lambda d: d["words"] > 0)
    return materialize(joined.select("doc_id", "body", "copy", "size", "source_size", "target", draws.alias("draws")), "mix-plan")


def taken(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target`` and ``taken``, the words that the mix takes of each document."""
    total = F.aggregate("draws", F.lit(0).cast("long"), lambda acc, d: acc + d["words"])
    return plan(docs).select("doc_id", "size", "source_size", "target", F.coalesce(total, F.lit(0).cast("long")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixture: a row for each time that a document is taken, with its ``shard``, its ``place`` there, the
    ``epoch`` and how many of its ``words`` are taken; then the columns of ``docs``. A shard holds ``SHARD`` blocks."""
    drawn = plan(docs).select("doc_id", "body", "copy", F.inline("draws"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(SEED), "epoch", "body", "doc_id", "copy"), "doc_id", "body", "copy", "epoch")
    placed = materialize(drawn.withColumn("place", (F.row_number().over(order) - 1).cast("long")), "mix-order")
    own = docs.toDF(*[f"_ll_{i}" for i in range(len(docs.columns))])
    own = own.withColumn("_ll_id", F.col(f"_ll_{docs.columns.index('doc_id')}").cast("long")).withColumn(
        "_ll_body", F.xxhash64(f"_ll_{docs.columns.index('text')}"))
    own = _numbered(own, ["_ll_id", "_ll_body"], "mix-rows")
    on = placed["doc_id"].eqNullSafe(own["_ll_id"]) & (placed["body"] == own["_ll_body"]) & (placed["copy"] == own["copy"])
    return placed.join(own, on).select("shard", "place", "epoch", "words", *[
        F.col(f"_ll_{i}").alias(c) for i, c in enumerate(docs.columns)])
