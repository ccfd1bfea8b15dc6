"""Choosing a subset of an archive listing by class and count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.functions.paths import is_image_key
from samplelake.operators.joins import join_narrow
from samplelake.operators.numbering import first_per_group
from samplelake.staging import stage

# Name parts of metadata files that are always kept.
METADATA_NAMES = ("wnids.txt", "words.txt", "val_annotations.txt", "boxes.txt")


def is_metadata(name: Column) -> Column:
    hit = F.lit(False)
    for part in METADATA_NAMES:
        hit = hit | name.contains(part)
    return hit


def train_class(name: Column) -> Column:
    """Folder right below the first ``/train/``, or null elsewhere."""
    after = F.split(name, "/train/", 2)
    return F.when(name.contains("/train/"), F.substring_index(F.get(after, F.lit(1)), "/", 1))


def count_class(name: Column) -> Column:
    """Class an image counts against: its train class, or its split as a whole."""
    return (
        F.when(name.contains("/train/"), F.concat(F.lit("train/"), train_class(name)))
        .when(name.contains("/val/"), F.lit("val"))
        .when(name.contains("/test/"), F.lit("test"))
    )


def class_order(archive: DataFrame) -> DataFrame:
    """Train classes of the archive, in order."""
    return (
        archive.select(train_class(F.col("name")).alias("class_id"))
        .filter(F.col("class_id").isNotNull())
        .distinct()
        .orderBy("class_id")
    )


def _in_first_classes(files: DataFrame, archive: DataFrame, n: int) -> DataFrame:
    """Files that are outside the train split, or in one of its first ``n`` classes.

    The table of allowed classes has at most ``n`` rows.
    """
    allowed = stage(class_order(archive).limit(n).withColumn("_allowed", F.lit(True)), "classes")
    tagged = files.withColumn("_class_id", train_class(F.col("name")))
    train = tagged.filter(F.col("_class_id").isNotNull())
    kept = join_narrow(train, allowed.withColumnRenamed("class_id", "_class_id"), ["_class_id"], "inner")
    return kept.select(*files.columns).unionByName(files.filter(train_class(F.col("name")).isNull()))


def limit_classes(archive: DataFrame, n: int) -> DataFrame:
    """Drop train files outside the first ``n`` classes; other files stay."""
    return _in_first_classes(archive, archive, n)


def limit_per_class(archive: DataFrame, m: int) -> DataFrame:
    """At most ``m`` images per class in archive order; files that are not images stay."""
    name = F.col("name")
    tagged = archive.withColumn("_class", F.when(is_image_key(name), count_class(name)))
    first = first_per_group(tagged.filter(F.col("_class").isNotNull()), ["_class"], ["pos"], m)
    rest = tagged.filter(F.col("_class").isNull())
    return first.unionByName(rest).drop("_class")


def select_subset(archive: DataFrame, classes: int | None = None, per_class: int | None = None) -> DataFrame:
    """Files to extract: metadata always, the rest by class and then by count."""
    files = archive.filter(~F.col("name").endswith("/"))
    always = files.filter(is_metadata(F.col("name")))
    chosen = files.filter(~is_metadata(F.col("name")))
    if classes is not None:
        # The class order is taken over every name, metadata included.
        chosen = _in_first_classes(chosen, archive, classes)
    if per_class is not None:
        chosen = limit_per_class(chosen, per_class)
    return always.unionByName(chosen)
