"""Shuffled fixed-size batches for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplelake.functions.permutation import index_at, permuted


def epoch_batches(
    samples: DataFrame,
    batch_size: int,
    *,
    epoch: int = 0,
    seed: int = 0,
    index: str = "idx",
    total: int | None = None,
    pad_last: bool = False,
) -> DataFrame:
    """Add ``epoch, batch_id, batch_pos`` in an order that depends on seed and epoch only.

    ``index`` numbers the samples from 0 without gaps, as a keyed dataset does; ``total``
    is their count, where it is known.  The place of a sample is a keyed permutation of
    its index, so an epoch costs no sort, no shuffle and no table.  With ``pad_last`` the
    last batch is filled up by repeating its last sample.
    """
    n = samples.count() if total is None else total
    place = permuted(F.col(index), n, seed, epoch) if n else F.lit(0).cast("long")
    placed = samples.withColumn("_place", place)
    batches = placed.select(
        *samples.columns,
        F.lit(epoch).alias("epoch"),
        F.call_function("div", F.col("_place"), F.lit(batch_size).cast("long")).alias("batch_id"),
        (F.col("_place") % batch_size).cast("int").alias("batch_pos"),
    )
    if not pad_last or n % batch_size == 0:
        return batches
    # One row, which the index finds: a filter on it reaches the files.
    last = samples.filter(F.col(index) == index_at(n - 1, n, seed, epoch))
    places = F.sequence(F.lit(n % batch_size), F.lit(batch_size - 1))
    filler = last.select(
        "*", F.lit(epoch).alias("epoch"), F.lit(n // batch_size).cast("long").alias("batch_id"), F.explode(places).alias("batch_pos")
    )
    return batches.unionByName(filler)


def max_steps(batches: DataFrame, steps: int) -> DataFrame:
    """The first ``steps`` batches."""
    return batches.filter(F.col("batch_id") < steps)
