"""Label dictionaries and class ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplelake.operators.joins import fits_broadcast, join_narrow
from samplelake.operators.numbering import number_rows
from samplelake.staging import stage


def _numbered(dictionary: DataFrame, order: list[str]) -> DataFrame:
    """Add ``idx`` in ``order``: in one task where the counted rows are few, else by ranges.

    The dictionary is kept as a table first, so it is aggregated only once.
    """
    kept = stage(dictionary, "labels")
    if not fits_broadcast(kept):
        return number_rows(kept, order, "idx")
    return kept.withColumn("idx", F.row_number().over(Window.orderBy(*order)) - 1)


def label_ids_first_seen(df: DataFrame, pos: str = "pos", label: str = "label") -> DataFrame:
    """``label, idx`` in order of first appearance.

    A lone file is its own label, so the dictionary may grow with the data; it is
    numbered like any other table.
    """
    firsts = (
        df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.min(pos).alias("_first"))
    )
    return _numbered(firsts, ["_first", label]).select(label, F.col("idx").cast("int"))


def label_ids_sorted(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, idx`` in label order."""
    distinct = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return _numbered(distinct, [label]).select(label, F.col("idx").cast("int"))


def encode_labels(
    df: DataFrame, ids: DataFrame, label: str = "label", missing: int | None = None, name: str = "cls_idx"
) -> DataFrame:
    """Add the class id of each row's label; ``missing`` replaces an unknown one."""
    coded = join_narrow(df, ids.select(label, F.col("idx").alias(name)), [label], "left")
    if missing is None:
        return coded
    return coded.withColumn(name, F.coalesce(F.col(name), F.lit(missing)))


def attach_class(done: DataFrame, manifest: DataFrame, on: list[str]) -> DataFrame:
    """Give finished samples the class their manifest row states."""
    return done.join(manifest.select(*on, "cls"), on, "left")


def class_count(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_distinct(label).alias("num_classes"))


def is_split_label(label: Column, splits: tuple[str, ...] = ("train", "val", "test")) -> Column:
    """Marks labels that are really split names, as when a root is listed without a split."""
    return label.isin(*splits)
