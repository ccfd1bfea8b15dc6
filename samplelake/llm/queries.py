"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from samplelake.llm import (
    decontaminate,
    language,
    licenses,
    lines,
    merkle,
    pieces,
    quality,
    secrets,
    sharding,
    simhash,
    spelling,
    toxicity,
    urls,
)
from samplelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), urls.rules_table(spark))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.document_ids(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_url_filter,
        op3_license_scan,
        op4_toxicity,
        op5_simhash,
        op6_sentencepiece,
        op7_language,
        op8_sharding,
        op9_quality,
        op10_secrets,
        op11_line_dedup,
        op12_merkle_manifest,
        op13_spelling_variants,
    )
}
SQL: dict[str, str] = {
    "op1_decontamination": decontaminate.SQL,
    "op2_url_filter": urls.sql(),
    "op3_license_scan": licenses.sql(),
    "op9_quality": quality.sql(),
    "op10_secrets": secrets.sql(),
    "op11_line_dedup": lines.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_spelling_variants": spelling.SQL,
}
