"""Dense global positions, shards and chunks.

``row_number()`` without a partition moves every row into one task.  Here rows are
range-partitioned and sorted on a unique order, written once, and each row's
position is its place in its own partition plus the rows of the partitions before
it.  Only one small row per partition is ever gathered.  Number narrow rows (keys
and labels) and fetch the heavy bytes later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplelake.functions.paths import shard_name
from samplelake.operators.joins import join_narrow
from samplelake.staging import stage

DEFAULT_SHARD_SIZE = 2000
# Above this, Catalyst stops keeping only the first rows of a group before the shuffle.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"

_PARTITION_SHIFT = 33
_ROW_MASK = (1 << _PARTITION_SHIFT) - 1


def _columns(order: list[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def number_rows(df: DataFrame, order: list[Column | str], name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in ``order``, which must be unique."""
    keys = _columns(order)
    placed = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_place", _PARTITION_SHIFT)
    # One row per written partition: the single-task window and the broadcast are
    # bounded by the partition count, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place").bitwiseAND(F.lit(_ROW_MASK)))
        .drop("_part", "_offset", "_place")
    )


def number_within(
    df: DataFrame, group: list[str], order: list[Column | str], name: str = "rank"
) -> DataFrame:
    """0-based position of each row inside its group, safe for a group of any size.

    A group spans as many range partitions as it needs; its start is the smallest
    global position in it.
    """
    numbered = number_rows(df, [*group, *order], "_global")
    starts = stage(numbered.groupBy(*group).agg(F.min("_global").alias("_start")), "starts")
    return (
        join_narrow(numbered, starts, group, "inner")
        .withColumn(name, F.col("_global") - F.col("_start"))
        .drop("_global", "_start")
    )


def first_per_group(df: DataFrame, group: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of every group, in an ``order`` that must be unique inside each.

    For a small ``n`` the rank filter is pushed below the shuffle, so at most ``n``
    rows of a group leave each task.  For a large one, groups are ranked across
    range partitions instead.
    """
    if n <= int(df.sparkSession.conf.get(GROUP_LIMIT)):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*_columns(order)))
        return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return number_within(df, group, order, "_rank").filter(F.col("_rank") < n).drop("_rank")


def shard_size_for(total: int, shards: int | None, size: int | None = None) -> int:
    """Shard size for a wanted shard count, else the given size or the default."""
    if shards is not None:
        return max(1, -(-total // shards))
    return size if size is not None else DEFAULT_SHARD_SIZE


def with_chunks(df: DataFrame, size: int, pos: str = "pos") -> DataFrame:
    """Cut a numbered sequence into chunks of ``size``; the last one may be short."""
    whole = F.call_function("div", F.col(pos), F.lit(size).cast("long"))
    return df.withColumn("chunk", whole).withColumn("chunk_pos", F.col(pos) % F.lit(size))


def with_shards(df: DataFrame, size: int, prefix: str = "shard", pos: str = "pos") -> DataFrame:
    """Add ``shard, shard_idx, sample_idx`` to numbered samples."""
    chunked = with_chunks(df, size, pos)
    return (
        chunked.withColumn("shard", shard_name(prefix, F.col("chunk")))
        .withColumnRenamed("chunk", "shard_idx")
        .withColumnRenamed("chunk_pos", "sample_idx")
        .drop(pos)
    )


def dense_index(df: DataFrame, order: list[Column | str], key_width: int = 10) -> DataFrame:
    """Add ``idx`` and its zero-padded text form ``idx_key``."""
    numbered = number_rows(df, order, "idx")
    return numbered.withColumn("idx_key", F.format_string(f"%0{key_width}d", F.col("idx")))
