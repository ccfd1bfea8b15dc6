"""A corpus pipeline of five stages, each one of the operators over all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from samplelake.llm import decontaminate, language, pieces, secrets, simhash
from samplelake.llm.common import table
from samplelake.staging import scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart; learned from those outside the held-out fold.

    Null texts and texts without a letter have no language and go.
    """
    return language.with_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: fingerprints of four-word shingles, linked at four or fewer differing bits.

    Null, empty and wordless texts share the fingerprint zero and are one group.
    """
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a placeholder in place of each secret."""
    return secrets.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_ids, ids, restored`` of each document."""
    return pieces.document_ids(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

# Hashes of shingles, compressed sizes, learned models and merges are not in SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder before the next reads it.

    What a stage wrote for itself goes with it, and its input goes once its output is written.
    """
    docs = table(spark, sf_dir, "documents")
    with scope() as all_but_last:
        for name, step in STAGES[:-2]:
            with scope() as inside:
                docs = inside.keep(step(spark, docs, sf_dir), name)
        name, step = STAGES[-2]
        docs = all_but_last.keep(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
