"""Corpus pipeline: documents in, packed training sequences out.

Every stage reads what the one before it wrote. The stages but the last return
the columns they were given; the last returns the pieces of the sequences.

Defined cases are those of the operators. In addition: where no row carries a
language to learn from, only texts without a letter are rejected; a document
all of whose lines were duplicates leaves with them; ``n_chars`` follows ``text``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, language, line_dedup, packing, simhash
from ledgerloom.llm.common import materialize, table

MIN_SCORE = 0.5       # posterior of the predicted language
MAX_SURPRISE = 3.0    # nats an n-gram beyond that language's own: texts of the learned languages stay below about 2


def _columns(docs: DataFrame):
    return [F.col(f"`{c}`") for c in docs.columns]


def _apart(docs: DataFrame) -> DataFrame:
    """Columns other than the operators' own under names that cannot clash."""
    return docs.toDF(*[c if c in ("doc_id", "text", "lang") else f"_ll_{i}" for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, texts of no clear language and texts of none of the learned languages."""
    model = language.fit(docs)
    if not model[0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    plain = _apart(docs)
    ok = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE) & (F.col("surprise") <= MAX_SURPRISE)
    return language.identify(plain, model).where(ok).select(*plain.columns).toDF(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every line of a group of similar lines but one; documents left without text go."""
    plain = _apart(docs)
    out = line_dedup.dedup_lines(plain).where((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    out = out.select(*plain.columns).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, whole."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: SQL expresses neither the hashes nor the tokenizer; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
