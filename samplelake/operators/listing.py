"""From an object listing to labelled samples and a shard manifest."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.functions.paths import (
    is_image_key,
    is_shard_key,
    is_sidecar,
    label_from_key,
    path_parts,
    sample_key_or_index,
    split_base,
)
from samplelake.operators.labels import encode_labels, label_ids_first_seen
from samplelake.operators.numbering import number_rows, with_shards


def filter_objects(objects: DataFrame, extensions: Iterable[str] | None = None) -> DataFrame:
    """Keep keys with one of the suffixes; none given keeps every object."""
    wanted = list(extensions or ())
    return objects.filter(is_shard_key(F.col("key"), wanted)) if wanted else objects


def filter_images(objects: DataFrame) -> DataFrame:
    return objects.filter(is_image_key(F.col("key")))


def labelled_samples(
    objects: DataFrame,
    prefix: str,
    *,
    split: str | None = None,
    extensions: Iterable[str] | None = None,
    with_labels: bool = True,
) -> DataFrame:
    """Objects of one split that are images, with the label of their path."""
    base = split_base(prefix, split)
    key = F.col("key")
    kept = objects.filter(key.startswith(base) & is_shard_key(key, extensions) & ~is_sidecar(key))
    label = label_from_key(key, base) if with_labels else F.lit(None).cast("string")
    return kept.withColumn("label", label)


def listing_order(by: str = "key") -> list[Column]:
    """Listing order: by key string, or by path parts with the key as tie-break."""
    if by == "parts":
        return [path_parts(F.col("key")), F.col("key")]
    return [F.col("key")]


def shard_manifest(
    samples: DataFrame,
    shard_size: int,
    *,
    shard_prefix: str = "shard",
    split: str | None = None,
    order: str = "key",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``shard, shard_idx, sample_idx, __key__, cls, source`` of labelled samples.

    ``keep`` names further columns of the samples to carry along.
    """
    numbered = number_rows(samples.select("key", "label", *keep), listing_order(order), "pos")
    return with_shards(numbered, shard_size, split or shard_prefix).select(
        "shard",
        "shard_idx",
        "sample_idx",
        sample_key_or_index(F.col("key"), F.col("sample_idx")).alias("__key__"),
        F.col("label").alias("cls"),
        F.col("key").alias("source"),
        *keep,
    )


def with_class_ids(manifest: DataFrame, shard_size: int) -> DataFrame:
    """Add ``cls_idx``, numbered by first appearance in the manifest."""
    pos = F.col("shard_idx") * F.lit(shard_size) + F.col("sample_idx")
    ids = label_ids_first_seen(manifest.withColumn("pos", pos), "pos", "cls")
    return encode_labels(manifest, ids, "cls")


def duplicate_keys(manifest: DataFrame) -> DataFrame:
    """Sample keys that several sources share, which a stem-keyed ledger would merge."""
    return (
        manifest.groupBy("__key__")
        .agg(F.count(F.lit(1)).alias("n"), F.min("source").alias("first_source"))
        .filter(F.col("n") > 1)
    )


def skip_missing(samples: DataFrame, listing: DataFrame) -> DataFrame:
    """Drop samples whose object is not listed, before anything is numbered."""
    return samples.join(listing.select("key"), "key", "left_semi")


def list_shards(objects: DataFrame) -> DataFrame:
    """Shard keys in order."""
    return objects.filter(F.col("key").endswith(".tar")).select("key").distinct().orderBy("key")


def detect_sharded(objects: DataFrame) -> DataFrame:
    """One row: does the listing hold manifest Parquet and at least one shard?"""
    meta = F.col("key").contains("metadata/") & F.col("key").endswith(".parquet")
    tar = F.col("key").endswith(".tar")
    return objects.agg(
        (F.coalesce(F.bool_or(meta), F.lit(False)) & F.coalesce(F.bool_or(tar), F.lit(False))).alias(
            "is_sharded"
        )
    )
