"""Datasets keyed by a dense index: layout, lookups and ordered reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplelake.operators.joins import fits_broadcast, join_split
from samplelake.staging import stage


def range_layout(dataset: DataFrame) -> DataFrame:
    """Order for writing: files hold disjoint index ranges, so a lookup skips the rest."""
    return dataset.repartitionByRange("idx").sortWithinPartitions("idx")


def lookup_one(dataset: DataFrame, index: int) -> DataFrame:
    """The record of one index; the filter reaches the Parquet row groups."""
    return dataset.filter(F.col("idx") == index)


def lookup_batch(requests: DataFrame, dataset: DataFrame) -> DataFrame:
    """Every request with its record; null columns where the index is missing.

    The dataset is cut to the range of the requested indices, which reaches its row
    groups, and few enough indices are copied to it, so that only the records found
    are moved.  They are then given back to the requests; an index asked for very
    often is split.
    """
    wanted = stage(requests.select("idx").filter(F.col("idx").isNotNull()).distinct(), "wanted")
    ends = wanted.agg(F.min("idx").alias("low"), F.max("idx").alias("high")).first()
    near = dataset.filter(F.col("idx").between(ends["low"], ends["high"]) if ends["low"] is not None else F.lit(False))
    few = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    return join_split(requests, near.join(few, "idx", "left_semi"), ["idx"], "left")


def missing_keys(requests: DataFrame, dataset: DataFrame) -> DataFrame:
    """Requested indices the dataset does not hold."""
    return requests.select("idx").distinct().join(dataset.select("idx"), "idx", "left_anti")


def check_found(found: DataFrame, column: str) -> DataFrame:
    """Fail the job at the first request whose record is missing."""
    return found.withColumn(
        column,
        F.when(
            F.col(column).isNull(),
            F.raise_error(F.concat(F.lit("Key not found: "), F.col("idx").cast("string"))),
        ).otherwise(F.col(column)),
    )


def iterate(dataset: DataFrame) -> DataFrame:
    """Records in index order."""
    return dataset.orderBy("idx")
