"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (alignment, decontaminate, html, language, line_dedup, merkle, mixing, packing, pii, secrets,
                            simhash, topk, warc)
from ledgerloom.llm.common import table

LLM_QUERIES: dict = {}
LLM_ORACLE: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        LLM_QUERIES[name] = fn
        return fn
    return deco


@query("op4_simhash")
def q_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_components(table(spark, sf, "documents"))


@query("op7_line_dedup")
def q_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines that repeat one kept elsewhere, or earlier in it."""
    return line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))


@query("op3_decontamination")
def q_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark windows in every document."""
    out = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op1_packing")
def q_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    return packing.pack(table(spark, sf, "documents"))


@query("op10_language_id")
def q_language(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op9_secrets")
def q_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scan(table(spark, sf, "documents"))


@query("op5_personal_data")
def q_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf, "documents"))


@query("op6_topk_search")
def q_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best rows by inner product for every twentieth row."""
    return topk.search(table(spark, sf, "embeddings"))


@query("op8_html_extraction")
def q_html(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf, "pages"))


@query("op2_warc_archive")
def q_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page archived and read back through the capture index."""
    return warc.archive_and_read(spark, table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_tokenizer_alignment")
def q_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens, groups and links of two tokenizers in every document."""
    return alignment.alignment(table(spark, sf, "documents"))


@query("op12_source_mixing")
def q_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of every document the mix of all sources takes."""
    return mixing.taken(table(spark, sf, "documents"))


@query("op13_merkle_manifest")
def q_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what its tampered text folds to."""
    return merkle.proofs(table(spark, sf, "documents"), merkle.every_fifth_lowered())


# --- DuckDB SQL --------------------------------------------------------------

LLM_ORACLE["op3_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
i AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS g
         FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM i)),
runs AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM d CROSS JOIN (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item, s, runs.n AS n FROM runs JOIN wins ON runs.g = wins.g AND runs.n = wins.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
          FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN names ON d.doc_id = names.doc_id
"""

LLM_ORACLE["op2_warc_archive"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM m
"""

LLM_ORACLE["op6_topk_search"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
             CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

LLM_ORACLE["op13_merkle_manifest"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
bytes AS (   -- CRC-32 of the decimal id, a byte at a time
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM d WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, s, i + 1, list_reduce([xor(c, CAST(ascii(s[i + 1]) AS BIGINT))] || list_transform(range(8), lambda x: CAST(0 AS BIGINT)),
         lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS BIGINT)) ELSE a // 2 END)
  FROM bytes WHERE i < length(s)),
crc AS (SELECT doc_id, xor(c, CAST(4294967295 AS BIGINT)) AS c FROM bytes WHERE i = length(s)),
leaf AS (SELECT d.doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS h,
                CASE WHEN c % 5 = 0 THEN sha256(head || coalesce(octet_length(encode(low)) || ':' || low, '-')) END AS forged
         FROM d LEFT JOIN crc ON d.doc_id = crc.doc_id),
tree AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM d)),
l AS (SELECT leaf.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
             count(*) OVER (PARTITION BY tree) AS n
      FROM leaf JOIN tree ON leaf.source IS NOT DISTINCT FROM tree.source),
low AS (
  SELECT tree, 0 AS level, pos, h, n FROM l
  UNION ALL
  SELECT tree, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 15) // 16 FROM low WHERE n > 1
  GROUP BY tree, level, pos // 16),
sub AS (SELECT tree, h FROM low WHERE n = 1),
top AS (
  SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM sub) AS n FROM sub
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 15) // 16 FROM top WHERE n > 1
  GROUP BY level, pos // 16),
root AS (SELECT h FROM top WHERE n = 1),
nodes AS (SELECT tree, level, pos, h FROM low WHERE n > 1 UNION ALL SELECT -1, level, pos, h FROM top WHERE n > 1),
step AS (
  SELECT tree, level, pos,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM nodes),
fold AS (
  SELECT tree AS t, pos AS p, CAST(0 AS BIGINT) AS k, tree, CAST(0 AS BIGINT) AS level, pos, coalesce(forged, h) AS acc, '' AS proof FROM l
  UNION ALL   -- past the last level of a source the top tree goes on
  SELECT t, p, f.k + 1, CASE WHEN s.tree IS NULL THEN -1 ELSE f.tree END, CASE WHEN s.tree IS NULL THEN 0 ELSE f.level + 1 END,
         CASE WHEN s.tree IS NULL THEN f.t ELSE f.pos // 16 END,
         CASE WHEN s.tree IS NULL THEN acc ELSE sha256(b || acc || a) END, CASE WHEN s.tree IS NULL THEN proof ELSE proof || b || a END
  FROM fold AS f LEFT JOIN step AS s ON f.tree = s.tree AND f.level = s.level AND f.pos = s.pos
  WHERE s.tree IS NOT NULL OR f.tree >= 0),
done AS (SELECT t, p, arg_max(acc, k) AS acc, arg_max(proof, k) AS proof FROM fold GROUP BY t, p)
SELECT l.doc_id, l.h AS leaf, sub.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root,
       acc = root.h AS verified
FROM l JOIN done ON l.tree = done.t AND l.pos = done.p JOIN sub ON l.tree = sub.tree JOIN root ON true
"""
