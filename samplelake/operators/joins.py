"""Joins whose left side may hold one key in a third of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplelake.staging import stage

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
HOT_ROWS = 1_000_000


def fits_broadcast(narrow: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True where a side has few enough rows and bytes to be copied to every task.

    Each task sends one row of sums, so the check gathers no rows.
    """
    texts = [F.octet_length(c) for c, kind in narrow.dtypes if kind in ("string", "binary")]
    wide = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(8 * len(narrow.columns)))
    found = narrow.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(wide.cast("long")), F.lit(0)).alias("size")).first()
    return found["n"] <= rows and found["size"] <= size


def _check(how: str) -> None:
    if how not in ("left", "inner"):
        raise ValueError("left rows are spread: use 'left' or 'inner'")


def join_narrow(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join with a dictionary: short columns, unique in ``on``.

    It is broadcast where its counted size allows, and joined by :func:`join_split`
    where it has grown with the data.
    """
    _check(how)
    if fits_broadcast(right, rows):
        return left.join(F.broadcast(right), on, how)
    return join_split(left, right, on, how)


def join_split(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join with a side of any width, unique in ``on``, splitting the left's hot keys.

    A key with more than ``hot_rows`` left rows is cut into portions of that size, and
    only the right rows of such keys are repeated, once per portion.  The table of hot
    keys that is broadcast has at most one row per ``hot_rows`` left rows.  Left rows
    with a null key match nothing and do not meet the shuffle.
    """
    _check(how)
    if left.count() <= hot_rows:  # too few rows for any key to be hot
        return left.join(right, on, how)
    whole = F.lit(True)
    for key in on:
        whole = whole & F.col(key).isNotNull()
    lost, left = left.filter(~whole), left.filter(whole)
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    copies = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    hot = F.broadcast(stage(counts.select(*on, copies.alias("_copies")), "hot"))
    known = F.coalesce("_copies", F.lit(1))
    # The row number tells even identical rows apart and is the same in a repeated task.
    portion = (F.monotonically_increasing_id() % known).cast("int")
    spread = left.join(hot, on, "left").withColumn("_portion", portion).drop("_copies")
    repeated = (
        right.join(hot, on, "left")
        .withColumn("_portion", F.explode(F.sequence(F.lit(0), known - 1)))
        .drop("_copies")
    )
    joined = spread.join(repeated, [*on, "_portion"], how).drop("_portion")
    return joined if how == "inner" else joined.unionByName(lost, allowMissingColumns=True)
