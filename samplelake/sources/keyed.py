"""Keyed datasets on disk: range-partitioned Parquet, a label table and a manifest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from samplelake.functions.values import source_hash
from samplelake.operators.numbering import dense_index
from samplelake.sources.objects import fetch_content, spread_by_bytes
from samplelake.sources.tables import NO_PATH

DATASET_SCHEMA = T.StructType(
    [
        T.StructField("idx", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("image", T.BinaryType()),
        T.StructField("label", T.IntegerType()),
    ]
)
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("count", T.LongType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("key_width", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("version_hash", T.StringType()),
        T.StructField("num_classes", T.LongType()),
        T.StructField("content_hash", T.StringType()),
    ]
)
VERSION = 1


def content_hash(key: Column, size: Column) -> Column:
    """Hash of a set of keys and sizes that does not depend on their order."""
    digest = F.md5(F.concat_ws(":", key, size.cast("string")))
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(part), F.lit(0).cast("decimal(38,0)"))
    # The lower 63 bits, which any number of records fits.
    return F.lower(F.hex((total % F.lit(str(1 << 63)).cast("decimal(38,0)")).cast("long")))


def write_keyed(
    samples: DataFrame,
    out: str,
    labels: DataFrame,
    *,
    source: str,
    key_width: int = 10,
    order: list[Column | str] | None = None,
) -> DataFrame:
    """Write listed samples (``path, key, size_bytes, cls_idx``) and return the manifest row.

    Samples are numbered and placed while they are narrow; the task that writes an
    index range reads its images.  ``labels`` (``label, idx``) is kept as a table, as
    there may be many.
    """
    spark = samples.sparkSession
    base = out.rstrip("/")
    narrow = samples.select("path", "key", "size_bytes", F.col("cls_idx").cast("int").alias("label"))
    numbered = dense_index(narrow, order or ["key"], key_width)
    placed = spread_by_bytes(numbered, "size_bytes", ["idx"])
    records = fetch_content(placed.select("path", "idx", "idx_key", "label"), name="image")
    records.select("idx", F.col("idx_key").alias("key"), "image", "label").write.mode("overwrite").parquet(
        f"{base}/data"
    )
    labels.write.mode("overwrite").parquet(f"{base}/labels")
    counts = numbered.agg(
        F.count(F.lit(1)).alias("count"),
        content_hash(F.col("key"), F.col("size_bytes")).alias("content_hash"),
    )
    classes = read_labels(spark, base).count()
    manifest = counts.select(
        "count",
        F.lit(VERSION).alias("version"),
        F.lit(base).alias("path"),
        F.lit(key_width).alias("key_width"),
        F.lit(source).alias("source"),
        source_hash(F.lit(source)).alias("version_hash"),
        F.lit(classes).cast("long").alias("num_classes"),
        "content_hash",
    )
    manifest.write.mode("overwrite").json(f"{base}/manifest")
    return load_manifest(spark, base)


def load_manifest(spark: SparkSession, out: str) -> DataFrame:
    """The manifest row of a keyed dataset; FileNotFoundError where there is none."""
    path = f"{out.rstrip('/')}/manifest"
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(path)
    except AnalysisException as e:
        if e.getCondition() != NO_PATH:
            raise
        raise FileNotFoundError(f"Manifest not found: {path}") from e


def read_keyed(spark: SparkSession, out: str) -> DataFrame:
    """``idx, key, image, label`` of a keyed dataset."""
    return spark.read.schema(DATASET_SCHEMA).parquet(f"{out.rstrip('/')}/data")


def read_labels(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out.rstrip('/')}/labels")


def dataset_length(spark: SparkSession, out: str) -> int:
    """Number of records, from the manifest."""
    return load_manifest(spark, out).first()["count"]
