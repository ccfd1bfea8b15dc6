"""Registered queries on listings, numbering, labels, ledgers and registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from samplelake.catalog import views as v
from samplelake.catalog.registering import query
from samplelake.functions import paths as p
from samplelake.functions import values as val
from samplelake.functions.permutation import permuted_sql
from samplelake.operators import batches, keyed, labels, ledger, listing, metrics, numbering, registry, scanning, selection
from samplelake.staging import stage

W = v.with_views
O = v.OBJECTS
SM = (v.OBJECTS, v.SAMPLES, v.MANIFEST)
IMAGE_RE = r"'\.(jpg|jpeg|png|gif|webp|bmp|tiff|tif)$'"


# --- listing and predicates ---------------------------------------------------


@query("list_objects", W(O) + """SELECT key, size_bytes FROM objects
  WHERE lower(key) LIKE '%.jpg' OR lower(key) LIKE '%.gif'""")
def list_objects(spark, sf):
    return listing.filter_objects(v.objects(spark, sf), ["jpg", ".GIF"]).select("key", "size_bytes")


@query("filter_image_keys", W(O) + f"SELECT key FROM objects WHERE regexp_matches(lower(key), {IMAGE_RE})")
def filter_image_keys(spark, sf):
    return listing.filter_images(v.objects(spark, sf)).select("key")


@query("filter_shard_ext", W(O) + r"""SELECT key, regexp_matches(lower(key), '\.(jpg|jpeg|png)$') AS by_default,
  regexp_matches(lower(key), '\.(jpg|jpeg|png|txt)$') AS by_list FROM objects""")
def filter_shard_ext(spark, sf):
    k = F.col("key")
    return v.objects(spark, sf).select(
        "key", p.is_shard_key(k).alias("by_default"), p.is_shard_key(k, v.EXTRA_EXTENSIONS).alias("by_list")
    )


@query("drop_sidecars", W(O) + r"""SELECT key FROM objects
  WHERE regexp_matches(lower(key), '\.(jpg|jpeg|png|txt)$') AND NOT ends_with(key, '_boxes.txt')
    AND NOT contains(key, 'val_annotations.txt')""")
def drop_sidecars(spark, sf):
    k = F.col("key")
    return v.objects(spark, sf).filter(p.is_shard_key(k, v.EXTRA_EXTENSIONS) & ~p.is_sidecar(k)).select("key")


@query("filter_split", W(O) + "SELECT key FROM objects WHERE starts_with(key, 'landing/val/')")
def filter_split(spark, sf):
    return v.objects(spark, sf).filter(F.col("key").startswith(p.split_base(v.PREFIX, "val"))).select("key")


@query("label_from_path", W(O) + r"""SELECT key, split_part(substr(key, 9), '/', 1) AS by_split,
  split_part(substr(key, 15), '/', 1) AS by_class,
  split_part(regexp_replace(regexp_extract(key, '[^/]*$'), '\.[^.]*$', ''), '_', 1) AS lone
  FROM objects WHERE starts_with(key, 'landing/train/')""")
def label_from_path(spark, sf):
    k = F.col("key")
    return v.objects(spark, sf).filter(k.startswith("landing/train/")).select(
        "key",
        p.label_from_key(k, "landing/").alias("by_split"),
        p.label_from_key(k, "landing/train/").alias("by_class"),
        p.label_from_key(p.file_name(k), "").alias("lone"),
    )


@query("sample_key", W(O) + r"""SELECT key, regexp_replace(regexp_extract(key, '[^/]*$'), '\.[^.]*$', '') AS sample_key
  FROM objects""")
def sample_key(spark, sf):
    return v.objects(spark, sf).select("key", p.sample_key(F.col("key")).alias("sample_key"))


@query("sample_key_fallback", W(O) + r"""SELECT doc_id, source_key,
  CASE WHEN regexp_replace(regexp_extract(source_key, '[^/]*$'), '\.[^.]*$', '') = '' THEN printf('%06d', doc_id)
       ELSE regexp_replace(regexp_extract(source_key, '[^/]*$'), '\.[^.]*$', '') END AS sample_key
  FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN key ELSE 'x/' || source || '/.jpg' END AS source_key FROM objects)""")
def sample_key_fallback(spark, sf):
    named = F.when(F.col("lang") == "en", F.col("key")).otherwise(F.concat(F.lit("x/"), "source", F.lit("/.jpg")))
    o = v.objects(spark, sf).select("doc_id", named.alias("source_key"))
    return o.withColumn("sample_key", p.sample_key_or_index(F.col("source_key"), F.col("doc_id")))


@query("skip_missing", W(O, v.SAMPLES) + """SELECT key, label FROM samples
  WHERE doc_id IN (SELECT doc_id FROM labels)""")
def skip_missing(spark, sf):
    # Objects still present are those of labelled documents.
    present = v.objects(spark, sf).join(v.table(spark, sf, "labels"), "doc_id", "left_semi")
    return listing.skip_missing(v.samples(spark, sf), present).select("key", "label")


@query("order_by_parts", W(O) + """, named AS (SELECT replace(key, '_', '-') AS key, doc_id FROM objects
  UNION ALL SELECT replace(key, '_', '-x/'), doc_id FROM objects)
  SELECT key, row_number() OVER (ORDER BY string_split(key, '/'), key) - 1 AS pos FROM named""")
def order_by_parts(spark, sf):
    o = v.objects(spark, sf).select("key")
    both = F.array(F.replace("key", F.lit("_"), F.lit("-")), F.replace("key", F.lit("_"), F.lit("-x/")))
    return numbering.number_rows(o.select(F.explode(both).alias("key")), listing.listing_order("parts"))


@query("order_by_key", W(O) + "SELECT key, row_number() OVER (ORDER BY key) - 1 AS pos FROM objects")
def order_by_key(spark, sf):
    return numbering.number_rows(v.objects(spark, sf).select("key"), listing.listing_order())


# --- manifest, shards, chunks -------------------------------------------------


@query("shard_manifest", W(*SM) + "SELECT shard, shard_idx, sample_idx, __key__, cls, source FROM manifest")
def shard_manifest(spark, sf):
    return v.manifest(spark, sf)


@query("duplicate_keys", W(O) + """SELECT __key__, count(*) AS n, min(source) AS first_source
  FROM (SELECT lang || '_' || printf('%06d', doc_id % 100) AS __key__, key AS source FROM objects)
  GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    stem = F.concat("lang", F.lit("_"), F.format_string("%06d", F.col("doc_id") % 100))
    o = v.objects(spark, sf).select(stem.alias("__key__"), F.col("key").alias("source"))
    return listing.duplicate_keys(o)


@query("list_shards", W(*SM) + """SELECT key, row_number() OVER (ORDER BY key) - 1 AS pos
  FROM (SELECT DISTINCT 'out/' || shard AS key FROM manifest)""")
def list_shards(spark, sf):
    m = v.manifest(spark, sf)
    keys = m.select(F.concat(F.lit("out/"), "shard").alias("key")).unionByName(
        m.select(F.concat(F.lit("out/"), "source").alias("key"))
    )
    return numbering.number_rows(listing.list_shards(keys), ["key"])


@query("dense_index", W(O, v.SAMPLES) + """SELECT key, label, row_number() OVER (ORDER BY key) - 1 AS idx,
  printf('%010d', row_number() OVER (ORDER BY key) - 1) AS idx_key
  FROM samples WHERE doc_id IN (SELECT doc_id FROM labels)""")
def dense_index(spark, sf):
    present = v.objects(spark, sf).join(v.table(spark, sf, "labels"), "doc_id", "left_semi")
    kept = listing.skip_missing(v.samples(spark, sf), present).select("key", "label")
    return numbering.dense_index(kept, ["key"])


@query("chunk_sizes", W(O) + """SELECT pos // 300 AS chunk, count(*) AS n, min(key) AS first_key, max(key) AS last_key
  FROM (SELECT key, row_number() OVER (ORDER BY key) - 1 AS pos FROM objects) GROUP BY 1""")
def chunk_sizes(spark, sf):
    numbered = numbering.number_rows(v.objects(spark, sf).select("key"), ["key"])
    return numbering.with_chunks(numbered, 300).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key")
    )


@query("shards_from_count", W(O, v.SAMPLES) + """, sized AS (
  SELECT greatest(1, ceil((SELECT count(*) FROM samples) / 7.0))::BIGINT AS size)
  SELECT pos // size AS shard_idx, count(*) AS n, min(size) AS shard_size
  FROM (SELECT row_number() OVER (ORDER BY key) - 1 AS pos FROM samples), sized GROUP BY 1""")
def shards_from_count(spark, sf):
    numbered = numbering.number_rows(v.samples(spark, sf).select("key"), ["key"])
    size = numbering.shard_size_for(numbered.count(), 7)
    return (
        numbering.with_shards(numbered, size)
        .groupBy("shard_idx")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("shard_size", F.lit(size).cast("long"))
    )


# --- labels -------------------------------------------------------------------


@query("label_ids_first_seen", W(O, v.SAMPLES) + """SELECT label, (row_number() OVER (ORDER BY first, label) - 1)::INTEGER AS idx
  FROM (SELECT label, min(doc_id) AS first FROM samples GROUP BY label)""")
def label_ids_first_seen(spark, sf):
    return labels.label_ids_first_seen(v.samples(spark, sf), "doc_id")


@query("label_ids_sorted", W(O, v.SAMPLES) + """SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS idx
  FROM (SELECT DISTINCT label FROM samples)""")
def label_ids_sorted(spark, sf):
    return labels.label_ids_sorted(v.samples(spark, sf))


@query("encode_labels", W(O, v.SAMPLES) + """, ids AS (
  SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS idx FROM (SELECT DISTINCT label FROM samples))
  SELECT key, o.source AS label, coalesce(idx, -1) AS cls_idx, coalesce(idx, 0) AS cls_or_zero
  FROM (SELECT key, CASE WHEN lang = 'de' THEN 'unseen' ELSE source END AS source FROM objects) o
  LEFT JOIN ids ON ids.label = o.source""")
def encode_labels(spark, sf):
    ids = labels.label_ids_sorted(v.samples(spark, sf))
    label = F.when(F.col("lang") == "de", F.lit("unseen")).otherwise(F.col("source"))
    coded = labels.encode_labels(v.objects(spark, sf).select("key", label.alias("label")), ids)
    return coded.select(
        "key", "label",
        F.coalesce("cls_idx", F.lit(-1)).alias("cls_idx"),
        F.coalesce("cls_idx", F.lit(0)).alias("cls_or_zero"),
    )


@query("class_map", W(O, v.SAMPLES) + """SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS idx,
  count(*) OVER () AS num_classes FROM (SELECT DISTINCT label FROM samples)""")
def class_map(spark, sf):
    s = v.samples(spark, sf)
    n = labels.class_count(s).first()["num_classes"]
    return labels.label_ids_sorted(s).withColumn("num_classes", F.lit(n).cast("long"))


@query("attach_class", W(*SM, v.LEDGER) + "SELECT shard, sample_idx, __key__, cls FROM ledger")
def attach_class(spark, sf):
    m = v.manifest(spark, sf)
    done = v.ledger(spark, sf, m).select("shard", "sample_idx", "__key__")
    return labels.attach_class(done, m, ["shard", "sample_idx"])


# --- subset selection -----------------------------------------------------------


@query("class_order", W(O, v.ARCHIVE) + """SELECT class_id, row_number() OVER (ORDER BY class_id) - 1 AS pos
  FROM (SELECT DISTINCT class_id FROM tagged WHERE class_id IS NOT NULL)""")
def class_order(spark, sf):
    return numbering.number_rows(selection.class_order(v.archive(spark, sf)), ["class_id"])


CLASSES = "SELECT DISTINCT class_id FROM tagged WHERE class_id IS NOT NULL ORDER BY class_id LIMIT 6"


@query("limit_classes", W(O, v.ARCHIVE) + f"""SELECT name, pos FROM tagged
  WHERE class_id IS NULL OR class_id IN ({CLASSES})""")
def limit_classes(spark, sf):
    return selection.limit_classes(v.archive(spark, sf), 6)


@query("limit_per_class", W(O, v.ARCHIVE) + """SELECT name, pos FROM tagged WHERE count_class IS NULL
  UNION ALL SELECT name, pos FROM tagged WHERE count_class IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY count_class ORDER BY pos) <= 5""")
def limit_per_class(spark, sf):
    return selection.limit_per_class(v.archive(spark, sf), 5)


@query("limit_per_class_many", W(O, v.ARCHIVE) + """SELECT name, pos FROM tagged WHERE count_class IS NULL
  UNION ALL SELECT name, pos FROM tagged WHERE count_class IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY count_class ORDER BY pos) <= 1200""")
def limit_per_class_many(spark, sf):
    return selection.limit_per_class(v.archive(spark, sf), 1200)


@query("select_subset", W(O, v.ARCHIVE) + f"""SELECT name, pos FROM tagged WHERE is_meta
  UNION ALL (SELECT name, pos FROM tagged WHERE NOT is_meta AND (class_id IS NULL OR class_id IN ({CLASSES}))
             AND count_class IS NULL)
  UNION ALL (SELECT name, pos FROM tagged WHERE NOT is_meta AND (class_id IS NULL OR class_id IN ({CLASSES}))
             AND count_class IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY count_class ORDER BY pos) <= 4)""")
def select_subset(spark, sf):
    return selection.select_subset(v.archive(spark, sf), classes=6, per_class=4)


# --- ledger and joins -----------------------------------------------------------


@query("join_manifest", W(*SM) + """SELECT shard, sample_idx, __key__, cls, strlen(body)::BIGINT AS n_bytes
  FROM manifest JOIN objects ON objects.key = manifest.source""")
def join_manifest(spark, sf):
    m = v.manifest(spark, sf)
    shard_samples = m.select("shard", "sample_idx", F.col("source").alias("key")).join(
        v.objects(spark, sf).select("key", F.col("size_bytes").alias("n_bytes")), "key"
    )
    return ledger.join_manifest(shard_samples, m).select("shard", "sample_idx", "__key__", "cls", "n_bytes")


@query("pending_work", W(*SM, v.LEDGER) + """SELECT 'job' AS job_id, shard, sample_idx, __key__ FROM manifest
  WHERE (shard, sample_idx) NOT IN (SELECT (shard, sample_idx) FROM ledger)""")
def pending_work(spark, sf):
    m = v.manifest(spark, sf).withColumn("job_id", F.lit("job"))
    return ledger.pending_work(m, v.ledger(spark, sf, m)).select("job_id", "shard", "sample_idx", "__key__")


def _pending(spark, sf):
    m = v.manifest(spark, sf).withColumn("job_id", F.lit("job"))
    return ledger.pending_work(m, v.ledger(spark, sf, m))


PENDING = """pending AS (SELECT * FROM manifest
  WHERE (shard, sample_idx) NOT IN (SELECT (shard, sample_idx) FROM ledger))"""


@query("pending_count", W(*SM, v.LEDGER, PENDING) + "SELECT count(*) AS n FROM pending")
def pending_count(spark, sf):
    return _pending(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@query("rows_per_shard", W(*SM, v.LEDGER, PENDING) + """SELECT shard, count(*) AS n, min(sample_idx) AS first_idx,
  max(sample_idx) AS last_idx FROM pending GROUP BY shard""")
def rows_per_shard(spark, sf):
    return ledger.rows_per_shard(_pending(spark, sf))


@query("needed_shards", W(*SM, v.LEDGER, PENDING) + "SELECT DISTINCT shard FROM pending")
def needed_shards(spark, sf):
    return ledger.needed_shards(_pending(spark, sf))


@query("produced_only", W(*SM, v.LEDGER) + "SELECT shard, sample_idx, source FROM ledger")
def produced_only(spark, sf):
    m = v.manifest(spark, sf)
    done = v.ledger(spark, sf, m)
    return ledger.produced_only(m, done, ["shard", "sample_idx"]).select("shard", "sample_idx", "source")


@query("keys_reconcile", W(*SM, v.LEDGER) + """SELECT __key__, 'missing' AS side FROM manifest
  WHERE __key__ NOT IN (SELECT __key__ FROM ledger)
  UNION ALL SELECT lang || '_' || printf('%06d', doc_id), 'unexpected' FROM objects
  WHERE doc_id IN (SELECT doc_id FROM labels) AND key NOT IN (SELECT source FROM manifest)
    AND regexp_matches(key, '\\.(jpg|JPEG|png)$')""")
def keys_reconcile(spark, sf):
    m = v.manifest(spark, sf)
    stray = v.objects(spark, sf).join(v.table(spark, sf, "labels"), "doc_id", "left_semi")
    processed = stray.filter(p.is_shard_key(F.col("key"))).select(p.sample_key(F.col("key")).alias("__key__"))
    return ledger.reconcile_keys(processed, m, ["__key__"])


@query("ledger_append", W(*SM, v.LEDGER) + """SELECT job_id, shard, sample_idx FROM ledger
  UNION SELECT 'job', shard, sample_idx FROM manifest WHERE cls < 'src15'""")
def ledger_append(spark, sf):
    m = v.manifest(spark, sf).withColumn("job_id", F.lit("job"))
    return ledger.append_ledger(v.ledger(spark, sf, m), m.filter(F.col("cls") < "src15"))


@query("detect_sharded", W(*SM) + """SELECT o.is_sharded AS plain, s.is_sharded AS sharded FROM
  (SELECT coalesce(bool_or(contains(key, 'metadata/') AND key LIKE '%.parquet'), false)
      AND coalesce(bool_or(key LIKE '%.tar'), false) AS is_sharded FROM objects) o,
  (SELECT count(*) > 0 AS is_sharded FROM manifest) s""")
def detect_sharded(spark, sf):
    plain = listing.detect_sharded(v.objects(spark, sf)).first()["is_sharded"]
    m = v.manifest(spark, sf)
    keys = m.select(F.explode(F.array("shard", F.lit("out/metadata/part.0.parquet"))).alias("key"))
    return listing.detect_sharded(keys).select(F.lit(plain).alias("plain"), F.col("is_sharded").alias("sharded"))


# --- registry and URL lists -----------------------------------------------------


@query("registry_read", W(v.SCANS) + """SELECT source_bucket, source_prefix, metadata_key,
  strftime("at", '%Y-%m-%d %H:%M:%S') AS "at", total, corrupted FROM scans""")
def registry_read(spark, sf):
    from samplelake.staging import staging_path

    path = staging_path(spark, "registry")
    empty = registry.read_registry(spark, path)
    registry.append_scan(v.scans(spark, sf), path)
    rows = empty.unionByName(registry.read_registry(spark, path))
    return rows.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


@query("registry_last_n", W(v.SCANS) + """SELECT metadata_key, total,
  row_number() OVER (ORDER BY "at" DESC, metadata_key DESC) AS newest
  FROM scans ORDER BY "at" DESC, metadata_key DESC LIMIT 50""")
def registry_last_n(spark, sf):
    last = registry.last_scans(v.scans(spark, sf))
    # Fifty rows at most: numbering them in one task is bounded.
    from pyspark.sql import Window

    newest = F.row_number().over(Window.orderBy(F.desc("at"), F.desc("metadata_key")))
    return last.select("metadata_key", "total", newest.cast("long").alias("newest"))


@query("url_list", W(v.URL_LINES) + """SELECT trim(line) AS url, row_number() OVER (ORDER BY line_no) - 1 AS pos
  FROM url_lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')""")
def url_list(spark, sf):
    from samplelake.sources.tables import clean_urls

    return numbering.number_rows(clean_urls(v.url_lines(spark, sf)), ["line_no"]).select("url", "pos")


@query("url_list_max", W(v.URL_LINES) + """SELECT trim(line) AS url FROM url_lines
  WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#') ORDER BY line_no LIMIT 100""")
def url_list_max(spark, sf):
    from samplelake.sources.tables import clean_urls

    return clean_urls(v.url_lines(spark, sf), 100).select("url")


# --- scan -----------------------------------------------------------------------


VALID = f"""facts AS (
  SELECT key, size_bytes, hx,
    CASE WHEN starts_with(hx, 'FFD8FF') THEN 'JPEG' WHEN starts_with(hx, '89504E470D0A1A0A') THEN 'PNG'
         WHEN starts_with(hx, '474946383761') OR starts_with(hx, '474946383961') THEN 'GIF'
         WHEN starts_with(hx, '424D') THEN 'BMP' WHEN starts_with(hx, '49492A00') OR starts_with(hx, '4D4D002A') THEN 'TIFF'
         WHEN starts_with(hx, '5035') OR starts_with(hx, '5036') THEN 'PPM'
         WHEN starts_with(hx, '52494646') AND substr(hx, 17, 8) = '57454250' THEN 'WEBP' END AS fmt
  FROM blobs WHERE regexp_matches(lower(key), {IMAGE_RE})),
judged AS (
  SELECT *, CASE WHEN fmt IS NULL THEN 'unrecognised image data'
    WHEN fmt = 'JPEG' AND NOT contains(hx, 'FFD9') THEN 'image data is truncated'
    WHEN fmt = 'PNG' AND NOT contains(hx, '49454E44AE426082') THEN 'image data is truncated' END AS error
  FROM facts),
metadata AS (
  SELECT key, size_bytes,
    CASE WHEN error IS NOT NULL THEN NULL WHEN fmt = 'PNG' THEN ('0x' || substr(hx, 33, 8))::INTEGER
         WHEN fmt = 'JPEG' THEN ('0x' || substr(hx, 23 + 2 * ('0x' || substr(hx, 9, 4))::INTEGER, 4))::INTEGER
         WHEN fmt = 'GIF' THEN ('0x' || substr(hx, 15, 2) || substr(hx, 13, 2))::INTEGER END AS width,
    CASE WHEN error IS NOT NULL THEN NULL WHEN fmt = 'PNG' THEN ('0x' || substr(hx, 41, 8))::INTEGER
         WHEN fmt = 'JPEG' THEN ('0x' || substr(hx, 19 + 2 * ('0x' || substr(hx, 9, 4))::INTEGER, 4))::INTEGER
         WHEN fmt = 'GIF' THEN ('0x' || substr(hx, 19, 2) || substr(hx, 17, 2))::INTEGER END AS height,
    CASE WHEN error IS NULL THEN fmt END AS format, error IS NOT NULL AS corrupted,
    error IS NULL AND fmt NOT IN ('JPEG', 'PNG', 'GIF', 'WEBP', 'BMP', 'TIFF') AS unexpected_format,
    error IS NULL AND (CASE WHEN fmt = 'PNG' THEN contains(hx, '65584966')
      WHEN fmt = 'JPEG' THEN substr(hx, 5, 4) = 'FFE1' AND substr(hx, 13, 12) = '457869660000'
      ELSE contains(hx, '457869660000') END) AS exif_present,
    error
  FROM judged)"""
SCAN = (O, v.BLOBS, VALID)


def scan_metadata(spark, sf):
    return scanning.validate_bytes(listing.filter_images(v.blobs(spark, sf)))


@query("validate_objects", W(*SCAN) + "SELECT * FROM metadata")
def validate_objects(spark, sf):
    return scan_metadata(spark, sf)


@query("unexpected_format", W(*SCAN) + "SELECT key, format FROM metadata WHERE unexpected_format")
def unexpected_format(spark, sf):
    return scanning.unexpected_formats(scan_metadata(spark, sf)).select("key", "format")


SUMMARY = """summary AS (SELECT count(*) AS total, count(*) FILTER (corrupted) AS corrupted,
  count(*) FILTER (unexpected_format) AS unexpected_format, coalesce(sum(size_bytes), 0)::BIGINT AS total_size_bytes,
  coalesce(sum(size_bytes) / count(*), 0) / 1048576.0::DOUBLE AS avg_size_mb FROM metadata)"""


@query("scan_summary", W(*SCAN, SUMMARY) + """SELECT total, corrupted, unexpected_format, total_size_bytes,
  round(avg_size_mb, 9) AS avg_size_mb FROM summary""")
def scan_summary(spark, sf):
    s = scanning.scan_summary(scan_metadata(spark, sf))
    return s.withColumn("avg_size_mb", F.round("avg_size_mb", 9))


@query("scan_report", W(*SCAN, SUMMARY) + """SELECT 'Found ' || total || ' images, ' || corrupted || ' corrupted, '
  || unexpected_format || ' unexpected format, avg size ' || printf('%.1f', avg_size_mb) || 'MB' AS report FROM summary""")
def scan_report(spark, sf):
    return scanning.scan_report(scanning.scan_summary(scan_metadata(spark, sf)))


@query("metadata_jsonl", W(*SCAN) + """SELECT '{"key":"' || key || '","size_bytes":' || size_bytes
  || CASE WHEN width IS NULL THEN '' ELSE ',"width":' || width END
  || CASE WHEN height IS NULL THEN '' ELSE ',"height":' || height END
  || CASE WHEN format IS NULL THEN '' ELSE ',"format":"' || format || '"' END
  || ',"corrupted":' || corrupted || ',"unexpected_format":' || unexpected_format || ',"exif_present":' || exif_present
  || CASE WHEN error IS NULL THEN '' ELSE ',"error":"' || error || '"' END || '}' AS line FROM metadata""")
def metadata_jsonl(spark, sf):
    return scanning.metadata_json(scan_metadata(spark, sf))


# --- scalar functions -------------------------------------------------------------


URIS = """uris AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'http://x/' || source
  WHEN lang = 'es' THEN 's3://' || source WHEN lang = 'fr' THEN 's3://' || source || '/' || lang || '/'
  ELSE 's3://' || source || '/' || lang || '/sub' END AS uri FROM documents)"""


def _uris(spark, sf):
    lang, source = F.col("lang"), F.col("source")
    uri = (
        F.when(lang == "de", F.concat(F.lit("http://x/"), source))
        .when(lang == "es", F.concat(F.lit("s3://"), source))
        .when(lang == "fr", F.concat(F.lit("s3://"), source, F.lit("/"), lang, F.lit("/")))
        .otherwise(F.concat(F.lit("s3://"), source, F.lit("/"), lang, F.lit("/sub")))
    )
    return v.table(spark, sf, "documents").select("doc_id", uri.alias("uri"))


PARSED = r"""parsed AS (SELECT doc_id, uri,
  CASE WHEN starts_with(uri, 's3://') THEN split_part(trim(substr(uri, 6), '/'), '/', 1) END AS bucket,
  CASE WHEN NOT starts_with(uri, 's3://') THEN NULL WHEN contains(trim(substr(uri, 6), '/'), '/')
       THEN regexp_replace(trim(substr(uri, 6), '/'), '^[^/]*/', '') || '/' ELSE '' END AS prefix FROM uris)"""


@query("parse_uri", W(URIS, PARSED) + "SELECT doc_id, uri, bucket, prefix FROM parsed")
def parse_uri(spark, sf):
    return _uris(spark, sf).withColumn("p", p.parse_uri(F.col("uri"))).select("doc_id", "uri", "p.bucket", "p.prefix")


@query("metadata_key", W(URIS, PARSED) + """SELECT doc_id, CASE WHEN prefix IS NOT NULL THEN 'metadata/' ||
  coalesce(nullif(trim(replace(prefix, '/', '_'), '_'), ''), 'scan') || '.jsonl' END AS metadata_key FROM parsed""")
def metadata_key(spark, sf):
    return parse_uri(spark, sf).select("doc_id", p.metadata_key(F.col("prefix")).alias("metadata_key"))


@query("job_id", W(URIS, PARSED) + """SELECT doc_id, bucket || '_' || trim(replace(prefix, '/', '_'), '_') AS job_id
  FROM parsed""")
def job_id(spark, sf):
    return parse_uri(spark, sf).select("doc_id", p.job_id(F.col("bucket"), F.col("prefix")).alias("job_id"))


@query("dest_key", W(O) + """SELECT key, CASE WHEN lang = 'en' THEN 'out//' WHEN lang = 'fr' THEN 'out' ELSE '' END AS prefix,
  CASE WHEN lang IN ('en', 'fr') THEN 'out/' || key ELSE key END AS dest FROM objects""")
def dest_key(spark, sf):
    prefix = F.when(F.col("lang") == "en", F.lit("out//")).when(F.col("lang") == "fr", F.lit("out")).otherwise(F.lit(""))
    o = v.objects(spark, sf).select("key", prefix.alias("prefix"))
    return o.withColumn("dest", p.dest_key(F.col("prefix"), F.col("key")))


@query("ext_from_content_type", """SELECT event_id, CASE event_type WHEN 'click' THEN '.jpg' WHEN 'view' THEN '.png'
  WHEN 'error' THEN '.tiff' ELSE '.jpg' END AS ext FROM events""")
def ext_from_content_type(spark, sf):
    kind = (
        F.when(F.col("event_type") == "click", F.lit("image/JPEG; q=1"))
        .when(F.col("event_type") == "view", F.lit(" image/png ;x"))
        .when(F.col("event_type") == "error", F.lit("image/tiff"))
        .when(F.col("event_type") == "purchase", F.lit("text/html"))
    )
    return v.table(spark, sf, "events").select("event_id", p.ext_from_content_type(kind).alias("ext"))


URL_FILES = r"""files AS (SELECT page_id, url || CASE length(html) % 5 WHEN 0 THEN '/a.PNG?x=.gif' WHEN 1 THEN '/b.jpeg'
  WHEN 2 THEN '/c.tif' WHEN 3 THEN '?q=.png' ELSE '' END AS url FROM pages),
exts AS (SELECT page_id, url, coalesce(nullif(regexp_extract(lower(split_part(url, '?', 1)),
  '(\.jpg|\.jpeg|\.png|\.gif|\.webp|\.bmp|\.tiff|\.tif)$', 1), ''), '.jpg') AS ext FROM files)"""


def _url_files(spark, sf):
    tail = F.get(F.array(*map(F.lit, ["/a.PNG?x=.gif", "/b.jpeg", "/c.tif", "?q=.png", ""])), F.length("html") % 5)
    return v.table(spark, sf, "pages").select("page_id", F.concat("url", tail).alias("url"))


@query("ext_from_url", W(URL_FILES) + "SELECT page_id, url, ext FROM exts")
def ext_from_url(spark, sf):
    return _url_files(spark, sf).withColumn("ext", p.ext_from_url(F.col("url")))


@query("url_file_name", W(URL_FILES) + "SELECT page_id, printf('%05d', page_id) || ext AS name FROM exts")
def url_file_name(spark, sf):
    ext = p.download_ext(F.lit(None).cast("string"), F.col("url"))
    return _url_files(spark, sf).select("page_id", p.download_name(F.col("page_id"), ext).alias("name"))


@query("version_hash", W(O) + "SELECT key, substr(sha256(key), 1, 12) AS version_hash FROM objects")
def version_hash(spark, sf):
    return v.objects(spark, sf).select("key", val.source_hash(F.col("key")).alias("version_hash"))


@query("class_bytes", """SELECT o_orderkey, upper(substr(x, 7, 2) || substr(x, 5, 2) || substr(x, 3, 2) || substr(x, 1, 2)) AS wire,
  o_custkey AS class_id FROM (SELECT o_orderkey, o_custkey, printf('%08x', o_custkey) AS x FROM orders)""")
def class_bytes(spark, sf):
    wire = val.class_to_bytes(F.col("o_custkey").cast("int"))
    return v.table(spark, sf, "orders").select(
        "o_orderkey", F.hex(wire).alias("wire"), val.class_from_bytes(wire).cast("long").alias("class_id")
    )


@query("iso_stamp", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS stamp,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || 'Z' AS whole FROM events
  WHERE date_trunc('second', ts) <> ts
  UNION ALL SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z', strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
  FROM events WHERE date_trunc('second', ts) = ts""")
def iso_stamp(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", val.iso_stamp(F.col("ts")).alias("stamp"),
        val.iso_stamp(F.date_trunc("second", "ts")).alias("whole"),
    )


# --- metrics ------------------------------------------------------------------------


def _agg(c):
    return f"round(avg({c}), 6) AS mean_{c}, max({c}) AS max_{c}"


@query("gauge_summary", W(v.GAUGES) + f"SELECT {', '.join(_agg(c) for c in metrics.GAUGES)} FROM gauges")
def gauge_summary(spark, sf):
    s = metrics.gauge_summary(v.gauges(spark, sf))
    return s.withColumns({c: F.round(c, 6) for c in s.columns if c.startswith("mean")})


@query("throughput", """SELECT total_images, steps, elapsed_seconds,
  round(total_images / elapsed_seconds, 6) AS images_per_sec, round(seconds / steps * 1000, 6) AS step_time_ms FROM
  (SELECT sum(user_id)::BIGINT AS total_images, count(*) AS steps, sum(value / 1000) AS seconds,
    round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS elapsed_seconds FROM events)""")
def throughput(spark, sf):
    steps = v.table(spark, sf, "events").select(
        F.col("user_id").alias("images"), (F.col("value") / 1000).alias("step_seconds"), "ts"
    )
    return metrics.throughput(steps).select(
        "total_images", "steps", F.round("elapsed_seconds", 6).alias("elapsed_seconds"),
        F.round("images_per_sec", 6).alias("images_per_sec"), F.round("step_time_ms", 6).alias("step_time_ms"),
    )


@query("phase_timings", """SELECT event_type AS phase, round(sum(value), 4) AS seconds, count(*) AS runs
  FROM events GROUP BY event_type""")
def phase_timings(spark, sf):
    runs = v.table(spark, sf, "events").select(F.col("event_type").alias("phase"), F.col("value").alias("seconds"))
    return metrics.phase_timings(runs).withColumn("seconds", F.round("seconds", 4))


# --- keyed data and batches -----------------------------------------------------------


KEYED = """keyed AS (SELECT row_number() OVER (ORDER BY key) - 1 AS idx, key, label, strlen(body)::BIGINT AS n_bytes
  FROM samples JOIN objects USING (key))"""
REQUESTS = """requests AS (SELECT event_id, user_id AS idx FROM events)"""


def keyed_samples(spark, sf):
    numbered = numbering.number_rows(
        v.samples(spark, sf).select("key", "label", F.col("size_bytes").alias("n_bytes")), ["key"], "idx"
    )
    return stage(keyed.range_layout(numbered), "keyed")


@query("lookup_one", W(O, v.SAMPLES, KEYED) + "SELECT idx, key, label, n_bytes FROM keyed WHERE idx = 17")
def lookup_one(spark, sf):
    return keyed.lookup_one(keyed_samples(spark, sf), 17).select("idx", "key", "label", "n_bytes")


@query("lookup_batch", W(O, v.SAMPLES, KEYED, REQUESTS) + """SELECT event_id, idx, key, label, n_bytes
  FROM requests LEFT JOIN keyed USING (idx)""")
def lookup_batch(spark, sf):
    requests = v.table(spark, sf, "events").select("event_id", F.col("user_id").alias("idx"))
    return keyed.lookup_batch(requests, keyed_samples(spark, sf))


@query("missing_keys", W(O, v.SAMPLES, KEYED) + """SELECT DISTINCT o_custkey AS idx FROM orders
  WHERE o_custkey NOT IN (SELECT idx FROM keyed)""")
def missing_keys(spark, sf):
    requests = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("idx"))
    return keyed.missing_keys(requests, keyed_samples(spark, sf))


BATCHES = "sample_ids AS (SELECT idx FROM keyed), " + permuted_sql("sample_ids", 7, 3) + """,
batches AS (SELECT key, label, 3 AS epoch, pos // 32 AS batch_id, (pos % 32)::INTEGER AS batch_pos
  FROM keyed JOIN permuted USING (idx))"""


def _batches(spark, sf, **options):
    return batches.epoch_batches(keyed_samples(spark, sf).select("idx", "key", "label"), 32, epoch=3, seed=7, **options).drop("idx")


@query("epoch_batches", W(O, v.SAMPLES, KEYED, BATCHES, recursive=True) + "SELECT * FROM batches")
def epoch_batches(spark, sf):
    return _batches(spark, sf)


@query("epoch_batches_padded", W(O, v.SAMPLES, KEYED, BATCHES, recursive=True) + """, tail AS (
  SELECT * FROM batches ORDER BY batch_id DESC, batch_pos DESC LIMIT 1)
  SELECT * FROM batches UNION ALL
  SELECT key, label, epoch, batch_id, p::INTEGER FROM tail, range(32) r(p) WHERE p > batch_pos""")
def epoch_batches_padded(spark, sf):
    return _batches(spark, sf, pad_last=True)


@query("max_steps", W(O, v.SAMPLES, KEYED, BATCHES, recursive=True) + "SELECT * FROM batches WHERE batch_id < 4")
def max_steps(spark, sf):
    return batches.max_steps(_batches(spark, sf), 4)


@query("image_folder", W(O) + """SELECT key, label, dense_rank() OVER (ORDER BY label)::INTEGER - 1 AS cls_idx FROM
  (SELECT key, split_part(substr(key, 13), '/', 1) AS label FROM objects WHERE starts_with(key, 'landing/val/')
   AND (lower(key) LIKE '%.jpg' OR lower(key) LIKE '%.jpeg' OR lower(key) LIKE '%.png'))""")
def image_folder(spark, sf):
    from samplelake.plans.jobs import image_folder as folder

    return folder(v.objects(spark, sf), v.PREFIX, split="val").select("key", "label", "cls_idx")
