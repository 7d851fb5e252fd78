"""Fuzzy line deduplication by MinHash.

A line is a piece of text between line feeds, compared after trimming and
lower-casing. Its signature covers its character shingles, the five characters
at every position (a shorter line is one shingle). Minimum
hashes of the shingles form bands; distinct lines that share a band and agree in
more than half of the hashes (14 bits of each) are candidates, and candidates whose exact Jaccard similarity over the shingle sets
is 0.8 or more are linked. Connected components of the links are found by
distributed star contraction, and of each component one line stays: the first
one in the document with the smallest ``doc_id``. Two lines of similarity 0.8
are candidates with a probability of 0.93, of 0.85 with 0.977, of 0.9 with 0.996.

No candidate is left out, but not all pairs of a band's group become rows. Each member is first compared
with the group's ``CENTRES`` smallest members; after the components of those
links are known, all other members of the groups that are still apart are compared with each
other, in pairs of blocks: every line that is a candidate of a line in another component is verified
against one such line, and what is then still apart against all of them. Two sketches are compared by a few
operations on long numbers in the join's condition.
Members of a large group meet their centres in ``SPLIT`` rows at a time, and
what else a group must know (its size, whether it is still apart) is broadcast
for the large groups, of which there are few. All is done in DataFrame operations.

Defined cases: null text is empty; blank lines are never duplicates and always
stay; rows that share a ``doc_id`` count as one document when a line's owner is
chosen (null sorts last), and each row keeps the first of its own repeats; rows
equal in id and text get equal results; a text without duplicates is unchanged;
lines and texts of any length count whole, and a text of many lines is cut in
time in proportion to them; an empty table gives an empty result. Extra columns pass through
:func:`dedup_lines` untouched.

``xxhash64`` names a line by two independent 64-bit values; one of them alone
names it inside the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, join_by_frequency, materialize

SHINGLE = 5
BLANK = " \t\r\x0b\x0c"
HASHES = 20
#: Positions of the minimum hashes in each of ten bands: every hash stands in two or three.
BANDS = [(0, 3, 5, 7, 19), (1, 2, 13, 16, 18), (4, 6, 9, 10, 14), (8, 11, 12, 15, 17), (0, 1, 4, 8, 13), (2, 3, 6, 11, 16),
         (5, 9, 12, 17, 18), (7, 10, 14, 15, 19), (0, 2, 9, 15, 18), (1, 5, 6, 8, 10)]
AGREE = 11                    # minimum hashes that a candidate pair has in common at least
SLOT = 15                     # bits of a minimum hash's place in a sketch: 14 of the hash, one that stays clear
BLOCK = 4096                  # members in one side of a pair of blocks
CENTRES = 16                  # members of a band's group that all others are compared with first
SPLIT = 2048                  # members of a band's group that meet its centres in one place


def _mask(i: int) -> int:
    """The i-th of evenly spread 64-bit numbers, signed: exclusive-or with it reorders the hashes."""
    x = (i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return x - (1 << 64) if x >> 63 else x


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))


def _lines(docs: DataFrame) -> DataFrame:
    """``(doc, th, pos, body, k1, k2)`` for every line that is not blank."""
    split = docs.select(_id().alias("doc"), F.xxhash64("text").alias("th"),
                        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    lines = split.select("doc", "th", "pos", F.lower(F.trim("line", F.lit(BLANK))).alias("body"))
    return lines.where("body <> ''").select("*", F.xxhash64("body").alias("k1"), F.xxhash64(F.lit("line"), "body").alias("k2"))


def _shingles(body):
    """The five characters at every position."""
    every = F.regexp_extract_all(body, F.lit(f"(?s)(?=(.{{{SHINGLE}}}))"), F.lit(1))
    return F.when(F.length(body) < SHINGLE, F.array(body)).otherwise(every)


def _set(body):
    return F.array_distinct(F.transform(_shingles(body), lambda s: F.xxhash64(s)))


def _once(expr):
    """A column that is computed once for each row, however the optimiser nests what is made of it."""
    return F.explode(F.array(expr))


def _rows(lines: DataFrame) -> DataFrame:
    """``(doc, k1, k2, nth, h)``: the hash of the five characters at every position, with the line's ``nth`` byte first."""
    n, raw = F.length("body"), F.col("body").cast("binary")
    last = F.octet_length(F.expr(f"left(body, length(body) - {SHINGLE})"))      # the byte where the last five begin
    starts = lines.select("doc", "k1", "k2", raw.alias("raw"), (F.octet_length("body") == n).alias("ascii"), F.explode(
        F.sequence(F.lit(0), F.when(n > SHINGLE, last).otherwise(0))).alias("nth"))
    at = F.col("nth") + 1
    starts = starts.where("ascii OR substring(raw, nth + 1, 1) < X'80' OR substring(raw, nth + 1, 1) >= X'C0'")
    wide = F.substring(F.substring("raw", at, F.lit(4 * SHINGLE)).cast("string"), 1, SHINGLE).cast("binary")
    piece = F.when(F.col("ascii"), F.substring("raw", at, F.lit(SHINGLE))).otherwise(wide)
    return starts.select("doc", "k1", "k2", "nth", F.xxhash64(piece).alias("h"))


def _sketch():
    """The columns ``s0`` to ``s4``: 14 bits of each minimum hash, four of them in a number."""
    per = HASHES // 5
    for j in range(5):
        words = [F.shiftleft(F.col(f"m{per * j + t}").bitwiseAND(F.lit((1 << SLOT - 1) - 1)), SLOT * t) for t in range(per)]
        yield sum(words[1:], words[0]).alias(f"s{j}")


WORDS = [f"s{j}" for j in range(5)]


def _agreeing(x: str, y: str):
    """How many minimum hashes the sketches of the frames with the aliases ``x`` and ``y`` have in common.

    Where two hashes are equal, the place of their difference holds 0, and the top bit less it stays.
    """
    top = F.lit(sum(1 << SLOT * t + SLOT - 1 for t in range(HASHES // 5)))
    same = [F.bit_count((top - F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))).bitwiseAND(top)) for w in WORDS]
    return sum(same[1:], same[0])


def _bodies(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """``(k1, body)`` of every line that occurs in a pair."""
    names = materialize(pairs.select(F.col("a").alias("k1")).union(pairs.select("b")).distinct(), "lines-named")
    return materialize(lines.join(names, "k1", "left_semi").groupBy("k1").agg(F.min("body").alias("body")), "lines-bodies")


def _verified(pairs: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets are similar enough, by exact Jaccard."""
    both = (pairs.join(bodies.select(F.col("k1").alias("a"), F.col("body").alias("ba")), "a")
            .join(bodies.select(F.col("k1").alias("b"), F.col("body").alias("bb")), "b"))
    both = both.select("a", "b", "bb", _once(_set(F.col("ba"))).alias("sa")).select("a", "b", "sa", _once(_set(F.col("bb"))).alias("sb"))
    both = both.where(F.least(F.size("sa"), F.size("sb")) >= similarity * F.greatest(F.size("sa"), F.size("sb")))
    common = F.size(F.array_intersect("sa", "sb"))
    ok = both.where(common >= similarity * (F.size("sa") + F.size("sb") - common)).select("a", "b")
    return materialize(ok, "lines-links")


def _candidates(members: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of members ``(band, k1, root, s0, ..)`` of one band's group, in different components, that agree.

    Every pair of a group is compared, in pairs of blocks: a group of any size is spread over all tasks.
    """
    sizes = materialize(members.groupBy("band").agg(F.count(F.lit(1)).alias("size")), "lines-sizes")
    placed = join_by_frequency(members, sizes, "band", "size").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("k1"), F.col("blocks")).cast("int"))
    placed = materialize(placed.drop("size"), "lines-placed")
    # few bytes, much work: dealt by number, not by size
    key, parts = ["band", "i", "j"], int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = placed.select("band", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"),
                      "k1", "root", *WORDS).repartition(parts, *key).alias("x")
    y = placed.select("band", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"),
                      "k1", "root", *WORDS).repartition(parts, *key).alias("y")
    on = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in key]
    new = (F.col("x.root") != F.col("y.root")) & ((F.col("x.i") != F.col("x.j")) | (F.col("x.k1") < F.col("y.k1")))
    both = x.hint("merge").join(y, on[0] & on[1] & on[2] & (_agreeing("x", "y") >= AGREE) & new)
    return both.select(F.col("x.k1").alias("a"), F.col("y.k1").alias("b"))


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with the component of each line, ``root``."""
    return members.join(roots, F.col("k1") == F.col("node"), "left").withColumn("root", F.coalesce("root", "k1")).drop("node")


def _apart(members: DataFrame) -> DataFrame:
    """Of ``members`` the groups that stand in more than one component."""
    members = materialize(members, "lines-held")
    mixed = members.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
    mixed = materialize(mixed.where("low < high").select("band", "size"), "lines-mixed")
    return materialize(join_by_frequency(members, mixed, "band", "size").drop("size"), "lines-apart")


def _star(roots: DataFrame) -> DataFrame:
    """Links that make the same components."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _compared(members: DataFrame, roots: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """The components ``roots``, joined by links between members ``(band, k1, root, s0, ..)`` of one band's group.

    First each candidate meets one other line; as that joins most of a group of near copies, few pairs are left
    between the components then, and each of them is verified.
    """
    pairs = _candidates(members)
    sides = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("k1"), F.col("b").alias("o")),
                                           F.struct(F.col("b").alias("k1"), F.col("a").alias("o")))).alias("p"))
    first = materialize(sides.groupBy("p.k1").agg(F.min("p.o").alias("o")), "lines-involved")
    once = materialize(first.select(F.least("k1", "o").alias("a"), F.greatest("k1", "o").alias("b")).distinct(), "lines-once")
    bodies = _bodies(once, lines)
    links = _star(roots).unionByName(_verified(once, bodies, similarity))
    roots = components(links, "lines-cc")
    members = members.drop("root").join(first, "k1", "left_semi")
    rest = _candidates(_apart(_rooted(members, roots)))
    rest = materialize(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "lines-rest")
    rest = rest.join(once, ["a", "b"], "left_anti")
    return components(_star(roots).unionByName(_verified(rest, bodies, similarity)), "lines-cc")


def line_groups(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``(k1, k2, root, owner)`` for every distinct line that is not the only one of its group."""
    lines = _lines(docs)
    mins = [F.min(F.col("h").bitwiseXOR(F.lit(_mask(i)))).alias(f"m{i}") for i in range(HASHES)]
    sigs = _rows(lines).groupBy("k1", "k2").agg(
        F.min("doc").alias("owner"), F.sum(F.when(F.col("nth") == 0, 1).otherwise(0)).alias("n"), *mins)
    bands = F.array(*[F.xxhash64(F.lit(i), *[f"m{j}" for j in band]) for i, band in enumerate(BANDS)])
    sigs = materialize(sigs.select("k1", "k2", "owner", "n", bands.alias("bands"), *_sketch()), "lines-signatures")

    members = sigs.select("k1", F.explode("bands").alias("band"))
    groups = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    groups = materialize(groups.where("size > 1"), "lines-bands")
    shared = materialize(join_by_frequency(members, groups, "band", "size").select("band", "size", "k1"), "lines-members")
    shared = materialize(shared.join(sigs.select("k1", *WORDS), "k1"), "lines-sketches")
    nth = F.row_number().over(Window.partitionBy("band").orderBy("k1"))
    centres = materialize(shared.withColumn("nth", nth).where(F.col("nth") <= CENTRES).drop("nth"), "lines-centres")
    # every member meets the centres of its group
    parts = F.ceil(F.col("size") / SPLIT).cast("long")
    x = centres.select("band", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), "k1", *WORDS).alias("x")
    y = shared.select("band", F.pmod(F.xxhash64("k1"), parts).alias("part"), "k1", *WORDS).alias("y")
    stars = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.part") == F.col("y.part"))
                   & (F.col("x.k1") < F.col("y.k1")) & (_agreeing("x", "y") >= AGREE))
    stars = materialize(stars.select(F.col("x.k1").alias("a"), F.col("y.k1").alias("b")).distinct(), "lines-close")
    roots = components(_verified(stars, _bodies(stars, lines), similarity), "lines-cc")

    # what the stars left apart: all members of the groups that are in more than one component; the centres have met all
    rest = _apart(_rooted(shared.where(f"size > {CENTRES}").select("band", "k1"), roots))
    rest = rest.join(centres.select("band", "k1"), ["band", "k1"], "left_anti").join(sigs.select("k1", *WORDS), "k1")
    roots = _compared(materialize(rest, "lines-others"), roots, lines, similarity)

    keys = sigs.join(roots, F.col("k1") == F.col("node"), "left").select(
        "k1", "k2", "owner", "n", F.coalesce("root", "k1").alias("root"))
    keys = materialize(keys, "lines-keys")
    shared = keys.groupBy("root").agg(F.sum("n").alias("n"), F.min("owner").alias("owner")).where("n > 1")
    return materialize(keys.select("k1", "k2", "root").join(shared.select("root", "owner"), "root"), "lines-shared")


def dedup_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``docs`` with repeated lines cut from ``text``; adds ``n_lines`` and ``n_dropped``."""
    shared = line_groups(docs, similarity)
    hits = _lines(docs).select("doc", "th", "pos", "k1", "k2").join(shared, ["k1", "k2"]).repartition("doc", "th")
    first = F.min("pos").over(Window.partitionBy("doc", "th", "root"))
    cut = (hits.withColumn("first", first).where("doc <> owner OR pos > first")
           .groupBy("doc", "th").agg(F.array_sort(F.collect_set("pos")).alias("pos")))
    # a text of one character a line: 1 where it is cut
    gap = F.transform("pos", lambda p, i: F.concat(F.repeat(F.lit("0"), p - F.when(i > 0, F.get("pos", i - 1) + 1).otherwise(0)), F.lit("1")))
    cut = cut.select(F.col("doc").alias("_ll_doc"), F.col("th").alias("_ll_th"), F.size("pos").alias("_ll_n"),
                     F.split(F.array_join(gap, ""), "").alias("_ll_cut"))
    parts = F.split(F.coalesce("text", F.lit("")), "\n")
    on = (_id() == F.col("_ll_doc")) & (F.xxhash64("text") == F.col("_ll_th"))
    kept = F.array_join(F.filter(parts, lambda line, i: F.coalesce(F.get("_ll_cut", i) != "1", F.lit(True))), "\n")
    cols = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return docs.join(cut, on, "left").select(
        *cols, F.when(F.col("_ll_cut").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("text"),
        F.size(parts).cast("long").alias("n_lines"), F.coalesce("_ll_n", F.lit(0)).cast("long").alias("n_dropped"))
