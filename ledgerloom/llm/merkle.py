"""Merkle manifest of a dataset, its inclusion proofs and their check, by nested-interval labels.

Every row is a leaf; the rows of a source form a tree, leaves in ascending ``doc_id``, and the sources' subroots
form a top tree of the same kind. A node is labelled with the interval ``[lo, hi)`` of leaf ranks that it covers.
Labels alone say how nodes relate: a node's parent is the one of the next level whose interval contains its own,
and its siblings are what the parent's interval holds beside its own. A containment join is an equality join on the
tree and on the level's bucket, ``lo`` divided by the leaves that a full node of that level covers.

Ranks come from a sort over all partitions, so that no source is sorted in one task. A level is one aggregation of
at most ``FANOUT`` nodes a group; ancestors are attached from the top down, a parent meeting its ``FANOUT`` children
at most. The driver sees the numbers of levels and of sources and the root.

Defined cases: a null field counts as ``-``; a null source is a source of its own, before all others; a null
``doc_id`` sorts first and is never tampered with; rows that share a ``doc_id`` are ordered by their leaf; equal rows
are leaves of their own, whose order does not matter; an empty text is a field of zero bytes; a text of any length is
hashed whole; an empty table has no rows and no root. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ascii_lower, materialize, ranked

FANOUT = 16
STEPS = "array<struct<before:string,after:string>>"


def digest(*parts):
    """Lower-case hex SHA-256 of the parts' bytes, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(col):
    """``-`` for null, else the value with its UTF-8 byte count before it."""
    text = col.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text):
    """The leaf of a row whose text is given."""
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


@dataclass
class Tree:
    """Leaves ``(tree, rank, size, ...)``; for each level its inner nodes ``(tree, bucket, lo, hi, run, d, n)``, where
    ``run`` lists the children and ``n`` counts the tree's nodes on the level; and ``tops``, ``(tree, d)``."""

    leaves: DataFrame
    levels: list[DataFrame]
    tops: DataFrame


def grow(leaves: DataFrame, label: str) -> Tree:
    """The trees over leaves ``(tree, rank, size, d, ...)``, level by level; a tree ends where one node remains."""
    nodes = leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "d", F.col("size").alias("n"))
    tops = nodes.where("n = 1").select("tree", "d")
    most, covers, levels = leaves.agg(F.max("size")).first()[0] or 0, 1, []
    while most > 1:
        covers, most = covers * FANOUT, -(-most // FANOUT)
        runs = nodes.where("n > 1").groupBy("tree", F.expr(f"lo div {covers}").alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "d"))).alias("run"),
            F.ceil(F.max("n") / FANOUT).alias("n"))
        level = materialize(runs.select(
            "tree", "bucket", F.col("run")[0]["lo"].alias("lo"), F.element_at("run", -1)["hi"].alias("hi"), "run",
            F.sha2(F.array_join(F.col("run.d"), ""), 256).alias("d"), "n"), f"{label}-{covers}")
        levels.append(level)
        nodes = level.select("tree", "lo", "hi", "d", "n")
        tops = tops.unionByName(nodes.where("n = 1").select("tree", "d"))
    return Tree(leaves, levels, tops)


def _siblings(run, lo, hi):
    """What is left of the parent's interval beside ``[lo, hi)``, as digests before and after."""
    def side(keep):
        return F.array_join(F.transform(F.filter(run, keep), lambda c: c["d"]), "")
    return F.struct(side(lambda c: c["hi"] <= lo).alias("before"), side(lambda c: c["lo"] >= hi).alias("after"))


def _under(nodes: DataFrame, parents: DataFrame, covers: int) -> DataFrame:
    """``nodes`` with ``steps``, the siblings on each level up to the root, by containment in their ``parents``."""
    p = parents.select(F.col("tree").alias("p_tree"), F.col("bucket").alias("p_bucket"), F.col("lo").alias("p_lo"),
                       F.col("hi").alias("p_hi"), F.col("run").alias("p_run"), "steps", "subroot")
    on = ((F.col("tree") == F.col("p_tree")) & (F.expr(f"lo div {covers}") == F.col("p_bucket"))
          & (F.col("lo") >= F.col("p_lo")) & (F.col("hi") <= F.col("p_hi")))
    own = F.array(_siblings(F.col("p_run"), F.col("lo"), F.col("hi")))
    return nodes.join(p, on).withColumn("steps", F.concat(own, "steps")).drop("p_tree", "p_bucket", "p_lo", "p_hi", "p_run")


def attach(tree: Tree, seeds: DataFrame, label: str) -> DataFrame:
    """The leaves with ``steps`` from their run up to the root; ``seeds`` ``(tree, steps, subroot)`` holds each top's."""
    above, covers = None, FANOUT ** (len(tree.levels) + 1)
    for level in reversed(tree.levels):
        nodes = level.drop("d")
        here = nodes.where("n = 1").join(seeds, "tree").select(*nodes.columns, "steps", "subroot")
        if above is not None:
            here = here.unionByName(_under(nodes.where("n > 1"), above, covers).select(*nodes.columns, "steps", "subroot"))
        covers //= FANOUT
        above = materialize(here, f"{label}-{covers}")
    leaves = tree.leaves
    out = leaves.where("size = 1").join(seeds, "tree").select(*leaves.columns, "steps", "subroot")
    if above is not None:
        spans = leaves.where("size > 1").withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1)
        out = out.unionByName(_under(spans, above, FANOUT).select(*leaves.columns, "steps", "subroot"))
    return out


def manifest(docs: DataFrame, tampered=None) -> tuple[Tree, Tree]:
    """The trees of the sources and the tree over them; ``tampered`` is a column of texts to fold in place of ``text``
    (null where it is untouched). Leaves keep ``doc_id``, ``source`` and ``forged``, the leaf of that text."""
    rows = docs.select(F.col("doc_id").cast("long"), "source", "lang", "n_chars", "text",
                       (F.lit(None).cast("string") if tampered is None else tampered).alias("_ll_forged"))
    forged = F.when(F.col("_ll_forged").isNotNull(), leaf(F.col("_ll_forged")))
    rows = materialize(rows.select("doc_id", "source", leaf(F.col("text")).alias("d"), forged.alias("forged")), "merkle-leaves")
    leaves = ranked(rows, ["source"], ["doc_id", "d"], "merkle-ranks").withColumnRenamed("grp", "tree")
    sources = grow(materialize(leaves, "merkle-leaves"), "merkle-level")
    tops = sources.tops
    top = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "d",
                      F.lit(tops.count()).cast("long").alias("size"))
    return sources, grow(materialize(top, "merkle-subroots"), "merkle-top")


def nodes(trees: tuple[Tree, Tree]) -> DataFrame:
    """The manifest as a table: ``(part, tree, level, lo, hi, digest)``, ``part`` being ``source`` or ``top``."""
    out = None
    for part, tree in zip(("source", "top"), trees):
        rows = tree.leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "d")
        for level, df in enumerate([rows, *tree.levels]):
            df = df.select(F.lit(part).alias("part"), "tree", F.lit(level).alias("level"), "lo", "hi", F.col("d").alias("digest"))
            out = df if out is None else out.unionByName(df)
    return out


def fold(start, steps):
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(steps, start, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proofs(docs: DataFrame, tampered=None) -> DataFrame:
    """One row a document: its leaf, subroot and root, ``proof_sha256`` over the siblings of its path, and
    ``folded_root``, which its tampered text, or else its own, gives with them; ``verified`` where it is the root."""
    sources, top = manifest(docs, tampered)
    row = top.tops.select("d").first()
    root = F.lit(row["d"] if row else None).cast("string")
    none = F.array().cast(STEPS)
    seed = top.tops.select("tree", none.alias("steps"), F.col("d").alias("subroot"))
    seeds = materialize(attach(top, seed, "merkle-up").select(F.col("rank").alias("tree"), "steps", F.col("d").alias("subroot")),
                        "merkle-seeds")
    out = attach(sources, seeds, "merkle-path")
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    folded = fold(F.coalesce("forged", "d"), F.col("steps"))
    return out.select("doc_id", F.col("d").alias("leaf"), "subroot", root.alias("root"), proof.alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def every_fifth_lowered():
    """The tampered text: A-Z lower-cased where 5 divides the CRC-32 of the decimal ``doc_id``."""
    return F.when(F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0, ascii_lower("text"))
