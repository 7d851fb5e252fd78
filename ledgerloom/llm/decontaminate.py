"""Benchmark decontamination by winnowing, in DataFrame operations only.

Texts become words (A-Z lower-cased, runs of digits, letters and non-ASCII).
Of every ``WINDOW`` consecutive hashes of ``GRAM`` words the smallest is kept.
Any shared span of ``GRAM + WINDOW - 1`` = 10 words contains one whole window on
both sides, so both keep the same hash: no span is missed. Documents and items
meet on kept hashes; each hit is then extended to the ten-word windows around
it, which are compared word by word, so no false hit stays either.

An item of one to nine words is a single window of its own length, looked up
under the hashes of all word runs of that length. The lengths are at most nine.

Defined cases: null or wordless texts have no words and no hits; an item without
words has no window; rows equal in ``doc_id`` and text get equal results; rows
that share an ``item_id`` are one item; an item without an id is named by the
empty string; empty tables give no hits, or no rows. Extra columns are ignored
by :func:`contamination` and kept by :func:`decontaminate`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ascii_lower, materialize

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 10
GRAM, WINDOW = 4, 7
BROADCAST_ROWS = 200_000       # of an id, a hash and a length: some MB


def words(col="text"):
    """The words of a text, in order."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(F.col(col), F.lit(""))), GAP), "")


def _pairwise(df: DataFrame, out: str, col: str, step: int, combine) -> DataFrame:
    """Column ``out``: ``combine(col[i], col[i + step])`` for each i; past the end only ``col[i]`` counts.

    Each step is a column of its own, so that it is computed once.
    """
    return df.withColumn(out, F.zip_with(col, F.slice(F.col(col), step + 1, (1 << 31) - 1 - step), combine))


def _grams(df: DataFrame) -> DataFrame:
    """Column ``grams`` of column ``w``: a hash of every four consecutive words."""
    one = df.withColumn("g1", F.transform("w", lambda x: F.xxhash64(x)))
    two = _pairwise(one, "g2", "g1", 1, lambda a, b: F.xxhash64(a, b))
    four = _pairwise(two, "g4", "g2", 2, lambda a, b: F.xxhash64(a, b))
    whole = F.slice(F.col("g4"), 1, F.greatest(F.size("w") - (GRAM - 1), F.lit(0)))      # the last three cover fewer words
    return four.withColumn("grams", whole).drop("g1", "g2", "g4")


def _kept(df: DataFrame) -> DataFrame:
    """Column ``kept``: the smallest of every seven consecutive grams, without repeats."""
    two = _pairwise(_grams(df), "m2", "grams", 1, lambda a, b: F.least(a, b))
    four = _pairwise(two, "m4", "m2", 2, lambda a, b: F.least(a, b))
    return _pairwise(four, "m7", "m4", 3, lambda a, b: F.least(a, b)).withColumn(
        "kept", F.array_distinct("m7")).drop("grams", "m2", "m4", "m7")


def _runs(w, n):
    """Every run of ``n`` words as text."""
    last = F.size(w) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(w, i + 1, n), " "))
                  ).otherwise(F.array().cast("array<string>"))


def _named_runs(n: int):
    """The hash of every run of ``n`` words, with ``n``."""
    return F.transform(F.array_distinct(_runs(F.col("w"), F.lit(n))),
                       lambda g: F.struct(F.lit(n).alias("n"), F.xxhash64(g).alias("h")))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written table of few rows; a larger one is left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _items(benchmark: DataFrame) -> DataFrame:
    """``(item, n, windows, prints)``: one row for each item text with words."""
    w = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words().alias("w"))
    w = _kept(w.where(F.size("w") > 0).distinct().withColumn("n", F.least(F.size("w"), F.lit(SPAN))))
    w = w.withColumn("windows", F.array_distinct(_runs(F.col("w"), F.col("n"))))
    prints = F.when(F.col("n") == SPAN, F.col("kept")).otherwise(
        F.transform("windows", lambda g: F.xxhash64(g)))
    return materialize(w.select("item", "n", "windows", prints.alias("prints")), "decontam-items")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated)`` for every row of ``docs``.

    ``n_hit`` counts the document's words inside any occurrence of any item's window.
    """
    items = _items(benchmark)
    short = sorted(r.n for r in items.where(F.col("n") < SPAN).select("n").distinct().collect())   # nine at most
    split = _kept(docs.select("doc_id", F.xxhash64("text").alias("th"), words().alias("w")))
    keep = [F.transform(F.when(F.size("w") >= SPAN, F.col("kept")).otherwise(F.array().cast("array<bigint>")),
                        lambda h: F.struct(F.lit(SPAN).alias("n"), h.alias("h")))]
    keep += [_named_runs(n) for n in short]
    prints = materialize(split.select("doc_id", "th", F.size("w").cast("long").alias("n_words"),
                                      F.concat(*keep).alias("prints")), "decontam-prints")

    wanted = _small(materialize(items.select("item", F.explode("prints").alias("h"), "n").distinct(), "decontam-wanted"))
    met = prints.select("doc_id", "th", F.explode("prints").alias("p")).select("doc_id", "th", "p.n", "p.h")
    met = materialize(met.join(wanted, ["n", "h"]).select("doc_id", "th", "item").distinct(), "decontam-met")

    # extend: the windows around every kept hash, compared as words
    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), "text")
    near = texts.join(_small(met), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("th")))
    near = _grams(near.select("doc_id", "th", "item", words().alias("w"))).join(_small(items), "item")
    near = near.withColumn("hit", F.filter(F.transform("grams", lambda g, i: F.when(F.array_contains("prints", g), i)),
                                           lambda i: i.isNotNull()))
    around = F.array_distinct(F.flatten(F.transform("hit", lambda i: F.sequence(
        F.greatest(i - (SPAN - GRAM), F.lit(0)), i))))
    starts = F.when(F.col("n") == SPAN, around).otherwise(F.sequence(F.lit(0), F.size("w") - 1))
    near = near.withColumn("starts", starts)
    true = F.filter("starts", lambda i: F.array_contains("windows", F.array_join(F.slice("w", i + 1, F.col("n")), " ")))
    hits = near.select("doc_id", "th", "item", "n", true.alias("starts"))
    hits = hits.select("doc_id", "th", "item", F.array_distinct(F.flatten(F.transform(
        "starts", lambda i: F.sequence(i, i + F.col("n") - 1)))).alias("at"))
    found = hits.groupBy("doc_id", "th").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.when(F.size("at") > 0, F.col("item")))).alias("items"))
    found = found.where("n_hit > 0").select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "n_hit", "items")
    out = prints.select("doc_id", "th", "n_words").join(
        found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.size(names).cast("long").alias("n_items"), names.alias("items"),
                      F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                      F.col("n_hit").isNotNull().alias("contaminated"), "th")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a window of any item."""
    bad = contamination(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias("_ll_d"), F.col("th").alias("_ll_t")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_ll_d")) & (F.xxhash64(docs["text"]) == F.col("_ll_t")),
                     "left_anti")
