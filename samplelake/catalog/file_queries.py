"""Registered queries whose files Spark writes from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from samplelake.catalog import views as v
from samplelake.catalog.image_queries import CELL_SUMS, pixels_sql, sums, sums_sql
from samplelake.catalog.listing_queries import SCAN, SM
from samplelake.catalog.registering import query
from samplelake.functions.permutation import permuted_sql
from samplelake.operators import keyed as keyed_ops
from samplelake.operators import metrics
from samplelake.plans import jobs
from samplelake.plans import steps as st
from samplelake.sources import images, keyed, objects, tables, tarshards
from samplelake.staging import staging_path
from samplelake.streaming import incremental, progress

W = v.with_views
O = v.OBJECTS


def text_files(spark, sf):
    """The objects view as one file per object."""
    root = staging_path(spark, "objects")
    objects.write_objects(v.spread(v.objects(spark, sf)), root, content="body")
    return root


def blob_files(spark, sf):
    root = staging_path(spark, "blobs-files")
    objects.write_objects(v.spread(v.blobs(spark, sf)), root)
    return root


def png_rows(spark, sf):
    """RGB images as PNG bytes under a labelled path."""
    rows = v.rgb_u8(spark, sf)
    key = F.concat(F.lit("pics/c"), F.col("label"), F.lit("/"), F.col("key"), F.lit(".png"))
    return rows.select(key.alias("key"), "label", images.encoded(F.col("image")).alias("content"))


def png_files(spark, sf):
    root = staging_path(spark, "pngs")
    objects.write_objects(png_rows(spark, sf), root)
    return root


# --- objects --------------------------------------------------------------------


@query("read_object", W(O) + """SELECT key, size_bytes, md5(body) AS digest FROM objects
  WHERE key = (SELECT min(key) FROM objects)""")
def read_object(spark, sf):
    root = text_files(spark, sf)
    first = objects.list_objects(spark, root).agg(F.min("key").alias("key")).first()["key"]
    return objects.read_object(spark, root, first).select("key", "size_bytes", F.md5("content").alias("digest"))


@query("read_prefix", W(O) + r"""SELECT key, size_bytes, md5(body) AS digest FROM objects
  WHERE regexp_matches(lower(key), '\.(jpg|jpeg|png|gif|webp|bmp|tiff|tif)$')""")
def read_prefix(spark, sf):
    found = objects.read_objects(spark, text_files(spark, sf), images_only=True)
    return found.select("key", "size_bytes", F.md5("content").alias("digest"))


@query("decode_images", W(v.RGB, v.RGB_U8) + """, named AS (
  SELECT 'pics/c' || label || '/' || key || '.png' AS key, px FROM rgb_u8) """ + sums_sql("named"))
def decode_images(spark, sf):
    found = images.decode_images(spark, png_files(spark, sf))
    return sums(st.transform_images(found, [st.ToRgb(bgr=True)], levels=True))


@query("scan_dataset", W(*SCAN) + r""", judged_again AS (
  -- No object of this view is a real image, so the decoder refuses every format it knows.
  SELECT *, error IS NULL AND format IN ('JPEG', 'PNG', 'GIF', 'BMP') AS refused FROM metadata)
  SELECT count(*) AS total, count(*) FILTER (corrupted OR refused) AS corrupted,
    count(*) FILTER (unexpected_format AND NOT refused) AS unexpected_format,
    (SELECT sum(strlen(hx) // 2)::BIGINT FROM blobs WHERE regexp_matches(lower(key), '\.(jpg|jpeg|png|gif|webp|bmp|tiff|tif)$')) AS total_size_bytes,
    count(*) FILTER (exif_present AND NOT refused) AS exif, 'metadata/landing.jsonl' AS metadata_key
  FROM judged_again""")
def scan_dataset(spark, sf):
    from samplelake.operators.registry import last_scans, read_registry

    out = staging_path(spark, "scan-out")
    summary = jobs.scan_dataset(
        spark, blob_files(spark, sf), out, bucket="lake", prefix="landing/"
    )
    lines = spark.read.json(f"{out}/metadata/landing.jsonl")
    exif = lines.agg(F.count_if("exif_present").alias("exif")).first()["exif"]
    recorded = last_scans(read_registry(spark, f"{out}/metadata/registry"), 1).first()["metadata_key"]
    return summary.drop("avg_size_mb").withColumns(
        {"exif": F.lit(exif).cast("long"), "metadata_key": F.lit(recorded)}
    )


# --- shards ---------------------------------------------------------------------


SHARDED = """coded AS (SELECT m.*, i.idx AS cls_idx, o.body FROM manifest m JOIN objects o ON o.key = m.source
  JOIN (SELECT cls, (row_number() OVER (ORDER BY min(source)) - 1)::INTEGER AS idx FROM manifest GROUP BY cls) i USING (cls))"""


def shard_rows(spark, sf):
    from samplelake.operators.listing import with_class_ids

    coded = with_class_ids(v.manifest(spark, sf), v.SHARD_SIZE)
    body = v.objects(spark, sf).select(F.col("key").alias("source"), F.encode("body", "UTF-8").alias("content"))
    return coded.join(body, "source").withColumnRenamed("__key__", "key")


def shard_folder(spark, sf):
    root = staging_path(spark, "tars")
    rows = shard_rows(spark, sf)
    members = tarshards.sample_members(F.col("content"), F.col("cls_idx"))
    written = tarshards.write_shards(rows.withColumn("members", members), root)
    return root, written


@query("write_shards", W(*SM) + "SELECT shard, count(*) AS samples FROM manifest GROUP BY shard")
def write_shards(spark, sf):
    return shard_folder(spark, sf)[1].select("shard", "samples")


@query("read_shards", W(*SM, SHARDED) + """SELECT shard, sample_idx, __key__ AS key, md5(body) AS digest,
  cls_idx AS cls FROM coded""")
def read_shards(spark, sf):
    from samplelake.functions.values import class_from_bytes

    found = tarshards.read_shards(spark, shard_folder(spark, sf)[0])
    m = F.col("members")
    return found.select(
        "shard", "sample_idx", "key", F.md5(m["jpg"]).alias("digest"), class_from_bytes(m["cls"]).alias("cls")
    )


@query("has_member", W(*SM, SHARDED) + """SELECT shard, sample_idx, __key__ AS key, strlen(body)::BIGINT AS n_bytes
  FROM coded WHERE cls < 'src5'""")
def has_member(spark, sf):
    root = staging_path(spark, "tars")
    kind = F.when(F.col("cls") < "src5", F.lit("jpg")).otherwise(F.lit("txt"))
    rows = shard_rows(spark, sf).withColumn("members", F.create_map(kind, F.col("content")))
    tarshards.write_shards(rows, root)
    found = tarshards.read_shards(spark, root).filter(tarshards.has_member(F.col("members")))
    size = F.octet_length(F.col("members")["jpg"]).cast("long")
    return found.select("shard", "sample_idx", "key", size.alias("n_bytes"))


@query("read_some_shards", W(*SM, v.LEDGER, SHARDED) + """SELECT shard, sample_idx, __key__ AS key FROM coded
  WHERE shard IN (SELECT shard FROM ledger WHERE cls < 'src12')""")
def read_some_shards(spark, sf):
    root, _ = shard_folder(spark, sf)
    m = v.manifest(spark, sf)
    wanted = v.ledger(spark, sf, m).filter(F.col("cls") < "src12").select("shard").distinct()
    return tarshards.read_shards(spark, root, wanted).select("shard", "sample_idx", "key")


@query("read_manifest", W(*SM) + "SELECT shard, shard_idx, sample_idx, __key__, cls, source FROM manifest")
def read_manifest(spark, sf):
    out = staging_path(spark, "manifest")
    tables.write_manifest(v.manifest(spark, sf), out)
    return tables.read_manifest(spark, out)


@query("shard_dataset", W(*SM, SHARDED) + """SELECT shard, shard_idx, sample_idx, __key__, cls, source, cls_idx,
  md5(body) AS digest FROM coded""")
def shard_dataset(spark, sf):
    root, out = text_files(spark, sf), staging_path(spark, "sharded")
    listing = objects.list_objects(spark, root)
    manifest = jobs.shard_dataset(listing, v.PREFIX, out, splits=["train"], shard_size=v.SHARD_SIZE)
    read = tarshards.read_shards(spark, out)
    digests = read.select("shard", "sample_idx", F.md5(F.col("members")["jpg"]).alias("digest"))
    return manifest.join(digests, ["shard", "sample_idx"])


# --- transform jobs -----------------------------------------------------------------


STEPS = [st.Augment(flip_h=True), st.Normalize()]


def _moved(key: str) -> str:
    # Levels go through single precision on the way: x / 255 * 255, truncated.
    return W(v.RGB, v.RGB_U8, pixels_sql("rgb_u8", 6, 3)) + f""", named AS (
      SELECT rgb_u8.key, {key} AS name FROM rgb_u8),
    widest AS (SELECT key, list_max(px) > 1 AS wide FROM rgb_u8),
    cells AS (SELECT name AS key, (y * 6 + 5 - x) * 3 + ch + 1 AS pos,
      floor((CASE WHEN wide THEN val / 255 ELSE val END)::FLOAT * 255.0::FLOAT) AS val
      FROM pixels JOIN named USING (key) JOIN widest USING (key)) {CELL_SUMS}"""


def unpacked(df):
    """Image bytes as an array of numbers."""
    hexed = F.hex(F.col("image.px"))
    count = F.octet_length("image.px")
    px = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("double"),
    )
    return sums(df, px)


@query("transform_flat", _moved("'pics/c' || label || '/' || rgb_u8.key || '.png'"))
def transform_flat(spark, sf):
    out = staging_path(spark, "flat-out")
    jobs.transform_flat(spark, png_files(spark, sf), STEPS, out, job="flat")
    return unpacked(jobs.read_transformed(spark, out))


@query("transform_sharded", _moved("rgb_u8.key"))
def transform_sharded(spark, sf):
    root, out = staging_path(spark, "png-tars"), staging_path(spark, "sharded-out")
    files = png_files(spark, sf)
    jobs.shard_dataset(objects.list_objects(spark, files), "pics/", root, shard_size=100)
    jobs.run_transform(spark, root, STEPS, out, job="sharded")
    found = tarshards.read_shards(spark, out)
    return unpacked(found.select("key", images.decoded(F.col("members")["png"]).alias("image")))


# --- keyed datasets -----------------------------------------------------------------


CONVERTED = """converted AS (
  SELECT row_number() OVER (ORDER BY string_split(key, '/'), key) - 1 AS idx, key, body, size_bytes,
         (dense_rank() OVER (ORDER BY label) - 1)::INTEGER AS label
  FROM samples JOIN objects USING (key))"""


def keyed_folder(spark, sf):
    root, out = text_files(spark, sf), staging_path(spark, "keyed")
    listing = objects.list_objects(spark, root)
    manifest = jobs.convert_keyed(listing, v.PREFIX, out, split="train", present=listing)
    return out, manifest


@query("keyed_dataset", W(O, v.SAMPLES, CONVERTED) + """SELECT idx, printf('%010d', idx) AS key, label,
  md5(body) AS digest FROM converted""")
def keyed_dataset(spark, sf):
    out, _ = keyed_folder(spark, sf)
    return keyed.read_keyed(spark, out).select("idx", "key", "label", F.md5("image").alias("digest"))


@query("iterate_keyed", W(O, v.SAMPLES, CONVERTED) + """SELECT idx, label, size_bytes AS n_bytes,
  (SELECT count(*) FROM converted) AS length FROM converted""")
def iterate_keyed(spark, sf):
    out, _ = keyed_folder(spark, sf)
    rows = keyed_ops.iterate(keyed.read_keyed(spark, out))
    size = F.octet_length("image").cast("long")
    return rows.select("idx", "label", size.alias("n_bytes"), F.lit(keyed.dataset_length(spark, out)).cast("long").alias("length"))


@query("dataset_manifest", W(O, v.SAMPLES, CONVERTED) + """SELECT count(*) AS count, 1 AS version, 10 AS key_width,
  'landing/train' AS source, substr(sha256('landing/train'), 1, 12) AS version_hash,
  count(DISTINCT label) AS num_classes,
  printf('%x', sum(('0x' || substr(md5(key || ':' || size_bytes), 1, 8))::BIGINT)::BIGINT) AS content_hash FROM converted""")
def dataset_manifest(spark, sf):
    out, _ = keyed_folder(spark, sf)
    return keyed.load_manifest(spark, out).drop("path")


@query("convert_keyed", W(O, v.SAMPLES, CONVERTED) + """SELECT s.label, min(c.label) AS idx, count(*) AS n
  FROM converted c JOIN samples s USING (key) GROUP BY s.label""")
def convert_keyed(spark, sf):
    out, _ = keyed_folder(spark, sf)
    counts = keyed.read_keyed(spark, out).groupBy(F.col("label").alias("idx")).agg(F.count(F.lit(1)).alias("n"))
    return keyed.read_labels(spark, out).join(counts, "idx")


@query("keyed_with_transform", W(v.RGB, v.RGB_U8) + """, numbered AS (
  SELECT key, label, row_number() OVER (ORDER BY label, key) - 1 AS idx,
         list_transform(px, lambda x: 255 - x) AS px FROM rgb_u8)
  SELECT idx, label, total FROM (
    SELECT idx, label, round(list_sum(list_transform(px, lambda x: x::DOUBLE)), 4) AS total FROM numbered)""")
def keyed_with_transform(spark, sf):
    out = staging_path(spark, "keyed-pngs")
    listing = objects.list_objects(spark, png_files(spark, sf))
    jobs.convert_keyed(listing, "pics/", out)
    seen = jobs.read_for_training(spark, out, [st.Custom(lambda im: 255 - im)])
    both = seen.select("idx", "label", F.col("idx").cast("string").alias("key"), "image")
    totals = sums(both).select(F.col("key").cast("long").alias("idx"), "total")
    return both.select("idx", "label").join(totals, "idx")


@query("training_batches", W(v.RGB, v.RGB_U8, """numbered AS (
  SELECT label, row_number() OVER (ORDER BY label, key) - 1 AS idx, list_transform(px, lambda x: 255 - x) AS px FROM rgb_u8),
ids AS (SELECT idx FROM numbered)""", permuted_sql("ids", 4, 2), recursive=True) + """SELECT 2 AS epoch, pos // 48 AS batch_id,
    (pos % 48)::INTEGER AS batch_pos, idx, label,
    round(list_sum(list_transform(px, lambda x: x::DOUBLE)), 4) AS total FROM numbered JOIN permuted USING (idx)""")
def training_batches(spark, sf):
    out = staging_path(spark, "keyed-pngs")
    jobs.convert_keyed(objects.list_objects(spark, png_files(spark, sf)), "pics/", out)
    seen = jobs.training_batches(spark, out, 48, [st.Custom(lambda im: 255 - im)], epoch=2, seed=4)
    total = F.aggregate(F.transform("image.px", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return seen.select("epoch", "batch_id", "batch_pos", "idx", "label", F.round(total, 4).alias("total"))


# --- metrics and streams ---------------------------------------------------------------


@query("metrics_csv", W(v.GAUGES) + f"SELECT step, {', '.join(metrics.GAUGES)} FROM gauges")
def metrics_csv(spark, sf):
    out = staging_path(spark, "metrics")
    rows = v.gauges(spark, sf)
    tables.write_metrics_csv(rows, out)
    return spark.read.schema(rows.schema).option("header", True).csv(out)


@query("incremental_scan", W(*SCAN) + """SELECT key, width, height, format, corrupted, unexpected_format,
  exif_present, error FROM metadata""")
def incremental_scan(spark, sf):
    root, out, mark = blob_files(spark, sf), staging_path(spark, "scanned"), staging_path(spark, "mark")
    incremental.incremental_scan(spark, root, out, mark)
    # A second call finds nothing new.
    return incremental.incremental_scan(spark, root, out, mark).drop("size_bytes")


@query("progress_windows", """SELECT strftime(time_bucket(INTERVAL 10 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def progress_windows(spark, sf):
    schema = v.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "value")
    counted = progress.progress_windows(timed)
    seen = progress.drain_windows(counted, staging_path(spark, "windows"), staging_path(spark, "mark"))
    return seen.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "n",
        F.round("total", 4).alias("total"),
    )
