"""Image bytes to pixels and back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplelake.functions import codecs
from samplelake.functions.formats import image_format
from samplelake.functions.paths import IMAGE_EXTENSIONS, is_image_key
from samplelake.plans.steps import ToRgb, kernel_column
from samplelake.sources.objects import key_under, write_objects
from samplelake.staging import stage, staging_path

# Names with an image suffix, in any case of letters.
IMAGE_GLOB = "*.{" + ",".join("".join(f"[{x}{x.upper()}]" for x in e[1:]) for e in IMAGE_EXTENSIONS) + "}"
# For reads of very many small files: some two thousand a task, where 4 MB for opening one
# makes it 32, and folders listed by tasks where a level has more than a few.
SMALL_FILES = {
    "spark.sql.files.openCostInBytes": str(64 << 10),
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "4",
}


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Settings for reads that are planned and run inside."""
    before = {name: spark.conf.get(name) for name in SMALL_FILES}
    try:
        for name, value in SMALL_FILES.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def decode_images(spark: SparkSession, root: str) -> DataFrame:
    """``key, height, width, image`` of the image files below ``root``, decoded by Spark.

    Files of other names are not opened.  An undecodable one has a height and width of -1
    and a null image.  Pixels are bytes in BGR order: put ``ToRgb(bgr=True)`` first in a chain.
    """
    files = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", IMAGE_GLOB)
    return image_rows(files.load(root), root)


def image_sizes(spark: SparkSession, root: str) -> DataFrame:
    """``key, width, height`` of the same files, decoded here and now and kept as a table."""
    with small_files(spark):
        return stage(decode_images(spark, root).select("key", "width", "height"), "sizes")


def image_rows(files: DataFrame, root: str) -> DataFrame:
    """Rows of the image source, in the columns of :func:`decode_images`."""
    # The origin is a URI, where only some characters are escaped and a plus stands for itself.
    origin = F.url_decode(F.regexp_replace(F.col("image.origin"), "[+]", "%2B"))
    key = key_under(origin, root)
    pixels = F.struct(
        F.col("image.height").alias("h"),
        F.col("image.width").alias("w"),
        F.col("image.nChannels").alias("c"),
        F.col("image.data").alias("px"),
    )
    return files.select(
        key.alias("key"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.when(F.col("image.height") >= 0, pixels).alias("image"),
    ).filter(is_image_key(F.col("key")))


def codec_installed(spark: SparkSession) -> bool:
    """True where the executors have a full image codec for Python."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([codecs.full_codec()])], ["found"])

    return spark.range(0, 1, 1, 1).mapInArrow(look, "found boolean").first()["found"]


def decode_content(rows: DataFrame, content: str = "content", decoder: str | None = None) -> DataFrame:
    """Replace image bytes by ``image``, RGB levels, and ``format``; the image is null where none can be read.

    With a codec on the executors ("python"), rows are decoded where they are.  Else
    ("spark") the bytes are written as files and read by the JVM's image source, which
    knows JPEG, PNG, GIF and BMP; call it for bounded portions of rows, as that source
    keeps its file names on the driver.
    """
    spark = rows.sparkSession
    fmt = image_format(F.col(content)).alias("format")
    if decoder == "python" or (decoder is None and codec_installed(spark)):
        image = kernel_column([], F.col(content), form="bytes")
        return rows.select("*", fmt, image.alias("image")).drop(content)
    kept = stage(rows.withColumn("_at", F.monotonically_increasing_id()), "encoded")
    folder = staging_path(spark, "decoding")
    name = F.concat((F.col("_at") % 1000).cast("string"), F.lit("/"), F.col("_at").cast("string"), F.lit(".jpg"))
    full = kept.filter(F.octet_length(content) > 0)
    narrow = kept.select(*[c for c in kept.columns if c != content], fmt)
    if write_objects(full.select(name.alias("key"), content), folder, content=content).isEmpty():
        return narrow.withColumn("image", kernel_column([], F.lit(None).cast("binary"), form="bytes")).drop("_at")
    read = image_rows(spark.read.format("image").option("recursiveFileLookup", True).load(folder), folder)
    read = read.filter(F.col("image").isNotNull())
    pixels = read.select(
        F.regexp_extract("key", r"(\d+)\.jpg$", 1).cast("long").alias("_at"),
        kernel_column([ToRgb(bgr=True)], F.col("image"), levels=True, form="bytes").alias("image"),
    )
    return narrow.join(pixels, "_at", "left").drop("_at")


def or_fail(image: Column, key: Column) -> Column:
    """The image; the job fails at one that could not be decoded."""
    return F.when(image.isNull(), F.raise_error(F.concat(F.lit("image cannot be decoded: "), key))).otherwise(image)


def decoded(content: Column) -> Column:
    """RGB image struct of image bytes, by what codec the executors have; null where it fails."""
    return kernel_column([], content, form="bytes")


def encoded(image: Column) -> Column:
    """PNG bytes of an image struct that holds levels."""
    return kernel_column([], image, levels=True, form="png")
