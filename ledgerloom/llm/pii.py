"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

1. Plain patterns find e-mail addresses, IP addresses, payment cards and phone
   numbers in every text. These base spans are always reported and are the
   seed entities.
2. The one and the two words before an entity are its lexical patterns. Tokens
   that hold a digit or an at sign and overlap no base span are candidates; the
   words before them are the same kind of pattern.
3. On the graph of patterns and instances over all documents, a pattern's
   confidence in a kind is the share of its distinct instances known to be of
   that kind, and its support is their number. Patterns of high confidence and
   support pass the kind on to their other instances of fitting shape, which
   raises further patterns in the next round, until a round adds none.
4. Candidates behind a confident pattern are reported as spans of that kind.

Every repeated pattern is quantified possessively and starts only at the
beginning of a run of its characters, so a scan is linear in the text. Counts
cover all documents; a very frequent pattern is aggregated before the shuffle.

Defined cases: null text is empty and has no spans; rows equal in ``doc_id`` and
text get equal results and count once in the graph; a candidate that two kinds
claim is reported under each, and one that two patterns of a kind claim is
reported once; words further than ``CONTEXT`` characters before an entity are not
its pattern, and a word that begins there counts whole or not at all; a text of
any length is scanned whole; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "A-Za-z0-9._%+-"
TOKEN = r"[^\s,;()\[\]{}<>\"'|=]"
PLAIN = r"[^\s,;()\[\]{}<>\"'|=0-9@]"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "candidate": rf"(?:(?<!{TOKEN})|\G){PLAIN}*+[0-9@]{TOKEN}*+",
}
CONTEXT = 48              # characters before an entity in which its pattern is looked for
CONFIDENCE = 0.8
SUPPORT = 5               # distinct known instances that a pattern needs
#: What a discovered instance must look like, by kind.
SHAPE = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^(?:[0-9]+\.){2,}[0-9]+|^[0-9A-Fa-f]*:[0-9A-Fa-f:]+:[0-9A-Fa-f]*$",
    "card": r"^(?:[^0-9]*[0-9]){12,19}[^0-9]*$",
    "phone": r"^[+0-9.()-]*(?:[0-9][.()-]*){7,15}$",
}


def _matches(text, kind: str):
    """The matches of one pattern: the length of the gap before each, the text before it, and the match itself."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)

    def tail(x):
        return F.right(x, F.lit(CONTEXT))

    def before(s, i):
        # every match has a character, so that so many pieces hold the context whatever matched there
        first = F.greatest(2 * i + 1 - 2 * CONTEXT, F.lit(1))
        gap = F.element_at(s["gaps"], i + 1)
        return F.when(F.length(gap) >= CONTEXT, tail(gap)).otherwise(
            tail(F.array_join(F.transform(F.sequence(first, 2 * i + 1), lambda k: F.element_at(s["pieces"], k)), "")))

    # arrays of one struct, so that matches and gaps are found once
    once = F.transform(F.array(F.struct(found.alias("found"), gaps.alias("gaps"))), lambda s: F.struct(
        s["found"].alias("found"), s["gaps"].alias("gaps"), F.flatten(F.zip_with(
            F.slice(s["gaps"], 1, F.size(s["found"])), s["found"], lambda g, m: F.array(tail(g), tail(m)))).alias("pieces")))
    numbered = F.transform(once, lambda s: F.transform(s["found"], lambda m, i: F.struct(
        i.alias("nth"), F.lit(kind).alias("kind"), F.length(F.element_at(s["gaps"], i + 1)).alias("gap"),
        before(s, i).alias("before"), m.alias("match"))))[0]
    empty = F.array().cast("array<struct<nth:int,kind:string,gap:int,before:string,match:string>>")
    needs = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, F.lit(True))
    return F.when(needs & (F.regexp_count(text, F.lit(PATTERNS[kind])) > 0), numbered).otherwise(empty)


def _luhn(digits):
    """Whether a string of digits passes the check: every second digit from the right counts double."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid():
    """Whether a match meets its kind's further conditions."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split("match", r"\."), lambda p: F.ltrim(p, F.lit("0")))
    small = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return (F.when(F.col("kind") == "ip", small)
            .when(F.col("kind") == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
            .when(F.col("kind") == "phone", n.between(9, 15))
            .otherwise(True))


def _entities(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, kind, start, end, match, before)``: valid base spans, and candidates that overlap none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", F.xxhash64("text").alias("th"),
                        F.explode(F.concat(*[_matches(text, k) for k in PATTERNS])).alias("m"))
    found = found.select("doc_id", "th", "m.*").repartition("doc_id", "th")
    found = found.dropDuplicates(["doc_id", "th", "kind", "nth"])        # of rows equal in id and text
    upto = F.sum(F.col("gap").cast("long") + F.length("match")).over(
        Window.partitionBy("doc_id", "th", "kind").orderBy("nth"))
    placed = found.select("doc_id", "th", "kind", "match", "before", upto.alias("end"))
    placed = placed.withColumn("start", F.col("end") - F.length("match")).where(_valid())
    # a candidate overlaps a base span if one that starts no later ends after its start, or one starts inside it
    base = F.col("kind") != "candidate"
    whose = Window.partitionBy("doc_id", "th")
    before = whose.orderBy("start", "end", base.desc()).rowsBetween(Window.unboundedPreceding, -1)
    # the rows after, as those before in the mirrored order: a frame that only grows is not computed anew for each row
    after = whose.orderBy(F.desc("start"), F.desc("end"), base.asc()).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(base, F.col("end"))).over(before)
    ahead = F.min(F.when(base, F.col("start"))).over(after)
    return placed.select("*", reach.alias("reach"), ahead.alias("ahead")).where(
        base | ((F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end")))
    ).drop("reach", "ahead")


def _edges(entities: DataFrame) -> DataFrame:
    """``(doc_id, th, kind, start, end, match, pattern)``: an entity with each pattern of the words before it."""
    said = F.regexp_extract_all(F.lower("before"), F.lit(r"\S+"), F.lit(0))
    # the first word of a full context may begin before it: a label is whole or none
    cut = (F.length("before") >= CONTEXT) & ~F.col("before").rlike(r"^\s")
    said = F.when(cut, F.slice(said, 2, CONTEXT)).otherwise(said)
    last = F.slice(said, -2, 2)
    one = F.when(F.size(said) >= 1, F.element_at(said, -1))
    two = F.when(F.size(said) >= 2, F.array_join(last, " "))
    return entities.withColumn("pattern", F.explode(F.array_compact(F.array(one, two))))


def _discover(entities: DataFrame) -> DataFrame:
    """``(pattern, kind)``: the patterns that the graph of all documents gives confidence in."""
    # an instance is known by its hash; a hot pattern shrinks to its distinct instances before the shuffle
    graph = _edges(entities).select("pattern", F.xxhash64("match").alias("x"), "kind", "match").distinct()
    shapes = F.array_compact(F.array(*[F.when((F.col("kind") == "candidate") & F.col("match").rlike(SHAPE[k]), k)
                                       for k in KINDS]))
    graph = materialize(graph.select("pattern", "x", F.when(F.col("kind") != "candidate", F.col("kind")).alias("known"),
                                     shapes.alias("shapes")), "pii-graph")
    sizes = graph.groupBy("pattern").agg(F.count_distinct("x").alias("all"))
    seeds = graph.where("known IS NOT NULL").select("pattern", "x", F.col("known").alias("kind"))
    known, found = seeds, -1
    while True:
        good = (known.groupBy("pattern", "kind").agg(F.count_distinct("x").alias("n")).where(F.col("n") >= SUPPORT)
                .join(sizes, "pattern").where(F.col("n") >= CONFIDENCE * F.col("all")).select("pattern", "kind"))
        good = materialize(good, "pii-patterns")
        # what is known only grows, and with it the patterns: done when a round adds none
        before, found = found, good.count()
        if found == before:
            return good
        # instances that a confident pattern vouches for are known under all their patterns
        new = (graph.where("known IS NULL").join(good, "pattern")
               .where(F.expr("array_contains(shapes, kind)")).select("x", "kind").distinct())
        known = materialize(seeds.unionByName(
            graph.where("known IS NULL").select("pattern", "x").join(new, "x").select("pattern", "x", "kind")), "pii-known")


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every row of ``docs(doc_id, text)``."""
    entities = materialize(_entities(docs), "pii-entities")
    good = _discover(entities)
    shape = F.expr(" OR ".join(f"(g.kind = '{k}' AND match RLIKE r'{SHAPE[k]}')" for k in KINDS))
    extra = (_edges(entities.where("kind = 'candidate'")).alias("e").join(good.alias("g"), "pattern").where(shape)
             .select("doc_id", "th", F.col("g.kind").alias("kind"), "start", "end", F.lit(False).alias("base")).distinct())
    spans = entities.where("kind <> 'candidate'").select("doc_id", "th", "kind", "start", "end", F.lit(True).alias("base"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    rows = spans.unionByName(extra).select("doc_id", "th", F.struct(
        order.alias("k"), "start", "end", "kind", "base").alias("s"))
    each = rows.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("s")).alias("s"))

    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(spans, kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("s", lambda s: s["base"])
    each = each.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), said(base).alias("base"), said(F.col("s")).alias("spans"),
                       *[count(base, k).alias(f"n_{k}") for k in KINDS])
    each = materialize(each, "pii-spans")
    out = docs.select("doc_id", F.xxhash64("text").alias("th")).join(
        each, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    return out.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))
