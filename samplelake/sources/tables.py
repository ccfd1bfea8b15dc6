"""Table-shaped sources and sinks: URL lists, metrics, manifests, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplelake.functions.paths import strip

# The one analysis error that means a table is not there yet.
NO_PATH = "PATH_NOT_FOUND"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("shard", T.StringType()),
        T.StructField("shard_idx", T.LongType()),
        T.StructField("sample_idx", T.LongType()),
        T.StructField("__key__", T.StringType()),
        T.StructField("cls", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def clean_urls(lines: DataFrame, max_urls: int | None = None) -> DataFrame:
    """URLs of ``line_no, line``: trimmed, without blanks and comments, in line order."""
    url = strip(F.col("line"))
    kept = lines.select("line_no", url.alias("url")).filter(
        (F.col("url") != "") & ~F.col("url").startswith("#")
    )
    return kept if max_urls is None else kept.orderBy("line_no").limit(max_urls)


def read_url_list(spark: SparkSession, path: str, max_urls: int | None = None) -> DataFrame:
    """``line_no, url`` of a text file, or of a CSV with a ``url`` column.

    Rows keep the order of the file: a text scan gives increasing ids by split.
    """
    table = spark.read.option("header", True).csv(path)
    if "url" in table.columns:
        lines = table.select(F.coalesce("url", F.lit("")).alias("line"))
    else:
        lines = spark.read.text(path).select(F.col("value").alias("line"))
    return clean_urls(lines.withColumn("line_no", F.monotonically_increasing_id()), max_urls)


def write_manifest(manifest: DataFrame, prefix: str) -> None:
    """Write the shard manifest below ``prefix``; extra columns such as class ids are kept."""
    manifest.write.mode("overwrite").parquet(f"{prefix.rstrip('/')}/metadata")


def read_manifest(spark: SparkSession, prefix: str) -> DataFrame:
    """Every part of the shard manifest below ``prefix``."""
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{prefix.rstrip('/')}/metadata")


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines; null fields are left out."""
    rows.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_metrics_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_text(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").text(path)
