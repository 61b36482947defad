"""A corpus from raw documents: drop toxic texts and repeated lines, keep one of each group of copies, drop benchmark leaks, encode.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next
stage's `docs`. All stages but the last return the columns of `documents`. A document is known by its doc_id: rows that
share one go or stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from framequarry.llm import decontaminate, jaccard_join, line_dedup, pieces, toxicity
from framequarry.llm.registry import read
from framequarry.session import stage, use_utc


def _without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """`docs` without the rows whose doc_id is in `bad` (null matches null)."""
    ids = bad.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_anti")


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; it is fitted on the labelled documents among its input."""
    return _without(docs, toxicity.classify(docs, read(spark, sf_dir, "labels")).where("rejected"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three-line windows repeat go from all but the first document; n_chars follows the text. All rows stay."""
    reduced = line_dedup.drop_repeated_lines(docs)
    changed = F.col("n_lines_removed") > 0
    return reduced.select(*[F.when(changed, F.length("text")).otherwise(F.col(c)).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays: the one with the group's smallest doc_id.

    Texts without words are linked with nothing and stay, as does a row without a doc_id in a group without one.
    """
    return _without(docs, jaccard_join.jaccard_components(docs).where("not doc_id <=> component_id"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return _without(docs, decontaminate.contamination(docs, read(spark, sf_dir, "benchmark")).where("contaminated"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, pieces, n_pieces, lossless of every document that is left."""
    return pieces.encode_texts(docs, pieces.row_key(F.col("doc_id")))


STAGES = [
    ("toxicity", toxic_texts), ("line_dedup", repeated_lines), ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks), ("sentencepiece", encoded),
]
#: The first and the last stage have no SQL form; tests hold each stage against its operator's brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(use_utc(spark), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
