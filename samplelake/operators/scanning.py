"""Validation of image objects and the summary of a scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.functions.formats import (
    HEAD_BYTES,
    has_exif_chunk,
    has_exif_marker,
    header_height,
    header_width,
    image_error,
    image_format,
    is_unexpected_format,
    jpeg_facts,
    lacks_last_chunk,
)

BYTES_PER_MB = float(1024 * 1024)
UNDECODABLE = "image cannot be decoded"
METADATA_COLUMNS = [
    "key",
    "size_bytes",
    "width",
    "height",
    "format",
    "corrupted",
    "unexpected_format",
    "exif_present",
    "error",
]


def validate_bytes(objects: DataFrame) -> DataFrame:
    """Scan metadata of objects with ``key, size_bytes, content``, from the bytes alone."""
    content = F.col("content")
    # The bytes are read once into a short head and a few flags.
    ends = objects.select(
        "key",
        "size_bytes",
        F.substring(content, 1, HEAD_BYTES).alias("_head"),
        lacks_last_chunk(content).alias("_cut_png"),
        has_exif_marker(content).alias("_exif_marker"),
        has_exif_chunk(content).alias("_exif_chunk"),
        F.when(image_format(content) == "JPEG", jpeg_facts(content)).alias("_jpeg"),
    )
    found = ends.withColumn("_fmt", image_format(F.col("_head")))
    head, fmt = F.col("_head"), F.col("_fmt")
    truncated = F.when(fmt == "JPEG", F.col("_jpeg.truncated")).otherwise((fmt == "PNG") & F.col("_cut_png"))
    return _metadata(
        found.select(
            "key",
            "size_bytes",
            fmt,
            image_error(truncated, fmt).alias("error"),
            F.coalesce("_jpeg.width", header_width(head, fmt)).alias("width"),
            F.coalesce("_jpeg.height", header_height(head, fmt)).alias("height"),
            F.when(fmt == "PNG", F.col("_exif_chunk"))
            .when(fmt == "JPEG", F.col("_jpeg.exif"))
            .otherwise(F.col("_exif_marker"))
            .alias("_exif"),
        )
    )


def _metadata(facts: DataFrame) -> DataFrame:
    good = F.col("error").isNull()
    fmt = F.col("_fmt")
    return facts.select(
        "key",
        "size_bytes",
        F.when(good, F.col("width")).alias("width"),
        F.when(good, F.col("height")).alias("height"),
        F.when(good, fmt).alias("format"),
        (~good).alias("corrupted"),
        (good & F.coalesce(is_unexpected_format(fmt), F.lit(False))).alias("unexpected_format"),
        (good & F.coalesce(F.col("_exif"), F.lit(False))).alias("exif_present"),
        "error",
    )


def add_decoded_size(metadata: DataFrame, decoded: DataFrame) -> DataFrame:
    """Combine byte facts with ``key, width, height`` from the image decoder.

    A height of -1 means the decoder failed; that makes an object corrupted unless
    its format is one the decoder does not know.  Only narrow rows are joined.
    """
    both = metadata.join(decoded.withColumnsRenamed({"width": "_w", "height": "_h"}), "key", "left")
    undecodable = (
        (F.col("_h") < 0) & F.col("error").isNull() & F.col("format").isin("JPEG", "PNG", "GIF", "BMP")
    )
    failed = F.coalesce(undecodable, F.lit(False))
    decoded_ok = F.col("_h") >= 0
    return both.select(
        "key",
        "size_bytes",
        F.when(decoded_ok & F.col("error").isNull(), F.col("_w"))
        .when(failed, F.lit(None))
        .otherwise(F.col("width"))
        .alias("width"),
        F.when(decoded_ok & F.col("error").isNull(), F.col("_h"))
        .when(failed, F.lit(None))
        .otherwise(F.col("height"))
        .alias("height"),
        F.when(~failed, F.col("format")).alias("format"),
        (F.col("corrupted") | failed).alias("corrupted"),
        (F.col("unexpected_format") & ~failed).alias("unexpected_format"),
        (F.col("exif_present") & ~failed).alias("exif_present"),
        F.when(failed, F.lit(UNDECODABLE)).otherwise(F.col("error")).alias("error"),
    )


def scan_summary(metadata: DataFrame) -> DataFrame:
    """Totals of a scan in one row; the average is 0 for an empty one."""
    total = F.count(F.lit(1))
    size = F.coalesce(F.sum("size_bytes"), F.lit(0))
    return metadata.agg(
        total.alias("total"),
        F.count_if("corrupted").alias("corrupted"),
        F.count_if("unexpected_format").alias("unexpected_format"),
        size.alias("total_size_bytes"),
        (F.coalesce(F.try_divide(size, total), F.lit(0.0)) / F.lit(BYTES_PER_MB)).alias("avg_size_mb"),
    )


def scan_report(summary: DataFrame) -> DataFrame:
    line = F.format_string(
        "Found %d images, %d corrupted, %d unexpected format, avg size %.1fMB",
        "total",
        "corrupted",
        "unexpected_format",
        "avg_size_mb",
    )
    return summary.select(line.alias("report"))


def metadata_json(metadata: DataFrame) -> DataFrame:
    """One JSON text per object; null fields are left out."""
    return metadata.select(F.to_json(F.struct(*METADATA_COLUMNS)).alias("line"))


def unexpected_formats(metadata: DataFrame, fmt: Column | None = None) -> DataFrame:
    return metadata.filter(is_unexpected_format(fmt if fmt is not None else F.col("format")))
