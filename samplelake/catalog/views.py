"""Views over the given tables, in Spark and as SQL, that stand for image listings,
images, metrics and URL lists in the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplelake.operators.listing import labelled_samples, shard_manifest
from samplelake.staging import stage

PREFIX = "landing/"
SHARD_SIZE = 50
EXTENSIONS = (".jpg", ".JPEG", ".png", ".gif", ".txt", ".webp", "_boxes.txt")
EXTRA_EXTENSIONS = ("jpg", "JPEG", ".png", "txt")
PNG_HEAD = "89504E470D0A1A0A0000000D49484452"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """At least a task per core.  One small file is one task, whatever work its rows cause."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 4 * cores else df.repartition(cores)


# --- listings ---------------------------------------------------------------


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ext = F.get(F.array(*map(F.lit, EXTENSIONS)), (F.col("doc_id") % 7).cast("int"))
    split = F.when(F.col("doc_id") % 5 == 0, F.lit("val")).otherwise(F.lit("train"))
    key = F.concat(
        F.lit(PREFIX), split, F.lit("/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("_"),
        F.format_string("%06d", "doc_id"), ext,
    )
    return docs.select(
        key.alias("key"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        F.col("text").alias("body"),
        "doc_id", "lang", "source", "n_chars",
    )


_EXT_LIST = "[" + ", ".join(f"'{e}'" for e in EXTENSIONS) + "]"
OBJECTS = f"""objects AS (
  SELECT '{PREFIX}' || CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END || '/' || source || '/'
         || lang || '_' || printf('%06d', doc_id) || ({_EXT_LIST})[(doc_id % 7 + 1)::INTEGER] AS key,
         strlen(text)::BIGINT AS size_bytes, text AS body, doc_id, lang, source, n_chars
  FROM documents)"""


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with image-like bytes: a header by suffix, the whole text, an end marker.

    Spanish images have lost their end, French GIF names hold another format.
    """
    d = F.col("doc_id")
    kind = d % 7
    spanish, french, english = (F.col("lang") == x for x in ("es", "fr", "en"))
    width = F.lpad(F.hex(1 + d % 300), 8, "0")
    height = F.lpad(F.hex(1 + F.col("n_chars") % 200), 8, "0")
    # A first segment of 16 bytes, with Exif in some, and a frame behind it.
    jpeg_head = F.concat(
        F.when((kind == 0) & english, F.lit("FFD8FFE10010457869660000")).otherwise(F.lit("FFD8FFE000104A4649460000")),
        F.lit("0000000000000000FFC0001108"),
        F.substring(height, 5, 4),
        F.substring(width, 5, 4),
    )

    def little(side):
        return F.concat(F.substring(side, 7, 2), F.substring(side, 5, 2))

    head = (
        F.when(kind <= 1, jpeg_head)
        .when(kind == 2, F.concat(F.lit(PNG_HEAD), width, height))
        .when((kind == 3) & french, F.lit("50360A"))
        .when(kind == 3, F.concat(F.lit("474946383961"), little(width), little(height)))
        .when(kind == 5, F.lit("524946460000000057454250"))
        .otherwise(F.lit(""))
    )
    tail = (
        F.when(spanish, F.lit(""))
        .when(kind <= 1, F.lit("FFD9"))
        .when(kind == 2, F.lit("49454E44AE426082"))
        .otherwise(F.lit(""))
    )
    content = F.concat(F.unhex(head), F.encode("body", "UTF-8"), F.unhex(tail))
    # Written once: a scan reads stored bytes, it does not rebuild them per check.
    return stage(objects(spark, sf_dir).select("key", "size_bytes", content.alias("content"), "doc_id"), "blobs")


BLOBS = f"""blob_parts AS (
  SELECT key, size_bytes, body, doc_id, doc_id % 7 AS kind, lang,
         printf('%08X', 1 + doc_id % 300) AS wh, printf('%08X', 1 + n_chars % 200) AS hh
  FROM objects),
blobs AS (
  SELECT key, size_bytes, doc_id,
    CASE WHEN kind <= 1 THEN CASE WHEN kind = 0 AND lang = 'en' THEN 'FFD8FFE10010457869660000' ELSE 'FFD8FFE000104A4649460000' END
           || '0000000000000000FFC0001108' || substr(hh, 5, 4) || substr(wh, 5, 4)
         WHEN kind = 2 THEN '{PNG_HEAD}' || wh || hh
         WHEN kind = 3 AND lang = 'fr' THEN '50360A'
         WHEN kind = 3 THEN '474946383961' || substr(wh, 7, 2) || substr(wh, 5, 2) || substr(hh, 7, 2) || substr(hh, 5, 2)
         WHEN kind = 5 THEN '524946460000000057454250' ELSE '' END
    || hex(encode(body)) ||
    CASE WHEN lang = 'es' THEN '' WHEN kind <= 1 THEN 'FFD9' WHEN kind = 2 THEN '49454E44AE426082' ELSE '' END AS hx
  FROM blob_parts)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_samples(objects(spark, sf_dir), PREFIX, split="train")


SAMPLES = f"""samples AS (
  SELECT key, doc_id, split_part(substr(key, {len(PREFIX + 'train/') + 1}), '/', 1) AS label
  FROM objects
  WHERE starts_with(key, '{PREFIX}train/')
    AND (lower(key) LIKE '%.jpg' OR lower(key) LIKE '%.jpeg' OR lower(key) LIKE '%.png'))"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_manifest(samples(spark, sf_dir), SHARD_SIZE, split="train")


_STEM = r"regexp_replace(regexp_extract(key, '[^/]*$'), '\.[^.]*$', '')"
MANIFEST = f"""placed AS (
  SELECT key, doc_id, label, row_number() OVER (ORDER BY key) - 1 AS pos FROM samples),
manifest AS (
  SELECT printf('train_%05d.tar', pos // {SHARD_SIZE}) AS shard, pos // {SHARD_SIZE} AS shard_idx,
         pos % {SHARD_SIZE} AS sample_idx, {_STEM} AS __key__, label AS cls, key AS source, doc_id
  FROM placed)"""


def doc_id_of(source) -> F.Column:
    """Document number held in a key of the ``objects`` view."""
    return F.regexp_extract(source, r"_(\d+)(\.|_boxes)", 1).cast("long")


def ledger(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Manifest rows whose document has been labelled: the work done so far."""
    done = table(spark, sf_dir, "labels").select("doc_id")
    return (
        rows.withColumn("doc_id", doc_id_of(F.col("source")))
        .join(done, "doc_id", "left_semi")
        .select(F.lit("job").alias("job_id"), "shard", "sample_idx", "__key__", "cls", "source")
    )


LEDGER = """ledger AS (
  SELECT 'job' AS job_id, shard, sample_idx, __key__, cls, source FROM manifest
  WHERE doc_id IN (SELECT doc_id FROM labels))"""


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    d = F.col("doc_id")
    split = F.when(d % 10 == 0, F.lit("test")).when(d % 10 == 5, F.lit("val")).otherwise(F.lit("train"))
    name = F.concat(
        F.lit("set/"), split, F.lit("/"), F.col("source"), F.lit("/images/"),
        F.substring_index("key", "/", -1),
    )
    return o.select(name.alias("name"), d.alias("pos"))


ARCHIVE = """archive AS (
  SELECT 'set/' || CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 5 THEN 'val' ELSE 'train' END
         || '/' || source || '/images/' || regexp_extract(key, '[^/]*$') AS name, doc_id AS pos
  FROM objects),
tagged AS (
  SELECT name, pos,
    CASE WHEN contains(name, '/train/') THEN split_part(split_part(name, '/train/', 2), '/', 1) END AS class_id,
    CASE WHEN NOT regexp_matches(lower(name), '\\.(jpg|jpeg|png|gif|webp|bmp|tiff|tif)$') THEN NULL
         WHEN contains(name, '/train/') THEN 'train/' || split_part(split_part(name, '/train/', 2), '/', 1)
         WHEN contains(name, '/val/') THEN 'val' WHEN contains(name, '/test/') THEN 'test' END AS count_class,
    contains(name, 'wnids.txt') OR contains(name, 'words.txt') OR contains(name, 'val_annotations.txt')
      OR contains(name, 'boxes.txt') AS is_meta
  FROM archive)"""


def url_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a URL list: every page's URL between blanks, a comment and an empty line."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    lines = F.array(F.concat(F.lit("  "), "url", F.lit(" ")), F.concat(F.lit("# "), "url"), F.lit(""))
    return p.select("page_id", F.posexplode(lines).alias("at", "line")).select(
        (F.col("page_id") * 3 + F.col("at")).alias("line_no"), "line"
    )


URL_LINES = """url_lines AS (
  SELECT page_id * 3 AS line_no, '  ' || url || ' ' AS line FROM pages
  UNION ALL SELECT page_id * 3 + 1, '# ' || url FROM pages
  UNION ALL SELECT page_id * 3 + 2, '' FROM pages)"""


# --- metrics and registry ---------------------------------------------------


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("step"),
        F.col("value").alias("gpu_util_pct"),
        (F.col("value") * 16).alias("mem_used_mb"),
        (F.col("user_id") * 1024).cast("double").alias("mem_total_mb"),
        (F.col("value") / 4).alias("torch_allocated_mb"),
    )


GAUGES = """gauges AS (
  SELECT event_id AS step, value AS gpu_util_pct, value * 16 AS mem_used_mb,
         (user_id * 1024)::DOUBLE AS mem_total_mb, value / 4 AS torch_allocated_mb FROM events)"""


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.lit("lake").alias("source_bucket"),
        F.col("o_orderpriority").alias("source_prefix"),
        F.concat(F.lit("metadata/"), F.format_string("%012d", "o_orderkey"), F.lit(".jsonl")).alias("metadata_key"),
        F.col("o_orderdate").cast("timestamp").alias("at"),
        F.floor("o_totalprice").cast("long").alias("total"),
        (F.col("o_custkey") % 100).alias("corrupted"),
    )


SCANS = """scans AS (
  SELECT 'lake' AS source_bucket, o_orderpriority AS source_prefix,
         'metadata/' || printf('%012d', o_orderkey) || '.jsonl' AS metadata_key, o_orderdate AS "at",
         floor(o_totalprice)::BIGINT AS total, o_custkey % 100 AS corrupted FROM orders)"""


# --- images -----------------------------------------------------------------


def _unit(x):
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x.cast("double") + F.lit(0.5))).cast("float")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8x8 single-channel float images in 0..1."""
    e = spread(table(spark, sf_dir, "embeddings"))
    return e.select(
        F.format_string("%010d", "vec_id").alias("key"),
        "label",
        F.struct(
            F.lit(8).alias("h"), F.lit(8).alias("w"), F.lit(1).alias("c"),
            F.transform("embedding", _unit).alias("px"),
        ).alias("image"),
    )


IMAGES = """images AS (
  SELECT printf('%010d', vec_id) AS key, label,
         list_transform(embedding, lambda x: least(1.0::DOUBLE, greatest(0.0::DOUBLE, x::DOUBLE + 0.5))::FLOAT) AS px
  FROM embeddings)"""


def rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4x6 RGB float images: the 64 values and eight grey ones."""
    e = spread(table(spark, sf_dir, "embeddings"))
    px = F.concat(F.transform("embedding", _unit), F.array_repeat(F.lit(0.25).cast("float"), 8))
    return e.select(
        F.format_string("%010d", "vec_id").alias("key"),
        "label",
        F.struct(F.lit(4).alias("h"), F.lit(6).alias("w"), F.lit(3).alias("c"), px.alias("px")).alias("image"),
    )


RGB = """rgb AS (
  SELECT printf('%010d', vec_id) AS key, label,
         list_concat(
           list_transform(embedding, lambda x: least(1.0::DOUBLE, greatest(0.0::DOUBLE, x::DOUBLE + 0.5))::FLOAT),
           [0.25::FLOAT, 0.25::FLOAT, 0.25::FLOAT, 0.25::FLOAT, 0.25::FLOAT, 0.25::FLOAT, 0.25::FLOAT, 0.25::FLOAT]) AS px
  FROM embeddings)"""


def _levels(df: DataFrame) -> DataFrame:
    img = F.col("image")
    px = F.transform(img["px"], lambda x: F.floor(x.cast("double") * 255).cast("float"))
    return df.withColumn("image", F.struct(img["h"].alias("h"), img["w"].alias("w"), img["c"].alias("c"), px.alias("px")))


def images_u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(images(spark, sf_dir))


def rgb_u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(rgb(spark, sf_dir))


IMAGES_U8 = """images_u8 AS (
  SELECT key, label, list_transform(px, lambda x: floor(x::DOUBLE * 255)::FLOAT) AS px FROM images)"""
RGB_U8 = """rgb_u8 AS (
  SELECT key, label, list_transform(px, lambda x: floor(x::DOUBLE * 255)::FLOAT) AS px FROM rgb)"""


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64x64 RGB images of levels: every row repeats the 64 values, shifted by the row."""
    e = spread(table(spark, sf_dir, "embeddings"))
    level = F.transform("embedding", lambda x: F.floor(_unit(x).cast("double") * 255).cast("float"))

    def row(y):
        at = (y * 7) % 64
        turned = F.concat(F.slice(F.col("line"), at + 1, F.lit(64) - at), F.slice(F.col("line"), F.lit(1), at))
        return F.flatten(F.array_repeat(turned, 3))

    rows = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(63)), row))
    return e.select(F.format_string("%010d", "vec_id").alias("key"), level.alias("line")).select(
        "key",
        F.struct(F.lit(64).alias("h"), F.lit(64).alias("w"), F.lit(3).alias("c"), rows.alias("px")).alias("image"),
    )


TILES = """tiles AS (
  SELECT key, y, x, ch, line[(((x * 3 + ch) + 7 * y) % 64 + 1)::INTEGER] AS val
  FROM (SELECT key, list_transform(px, lambda v: floor(v::DOUBLE * 255)) AS line FROM images),
       range(64) a(y), range(64) b(x), range(3) d(ch))"""


def with_views(*views: str, recursive: bool = False) -> str:
    """``WITH`` clause of the given view definitions."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(views) + "\n"
