"""Jobs a user calls, composed from the operators.

Output is always written before the ledger row that names it.  A job that stops in
between repeats that work on the next run and loses none.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from samplelake.functions.formats import image_format
from samplelake.functions.paths import dest_key, flat_prefix, metadata_key, split_base
from samplelake.operators import ledger as led
from samplelake.operators import scanning
from samplelake.operators.batches import epoch_batches
from samplelake.operators.batches import max_steps as first_batches
from samplelake.operators.labels import encode_labels, label_ids_sorted
from samplelake.operators.listing import (
    detect_sharded,
    filter_images,
    labelled_samples,
    listing_order,
    skip_missing,
    with_class_ids,
)
from samplelake.operators.listing import shard_manifest as manifest_of
from samplelake.operators.numbering import DEFAULT_SHARD_SIZE, number_rows, shard_size_for
from samplelake.operators.registry import append_scan
from samplelake.plans.config import shard_config
from samplelake.plans.steps import Step, ToLevels, kernel_column
from samplelake.sources import keyed, objects, tables, tarshards
from samplelake.sources.images import codec_installed, decode_content, image_sizes, or_fail
from samplelake.staging import stage

# Work between two ledger entries, which is what a stopped job repeats at most.
WAVE_FILES = 1_000_000
WAVE_SHARDS = 20_000

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("sample_idx", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)
# Formats both decoders know.
DECODED_FORMATS = ("JPEG", "PNG", "GIF", "BMP")


@dataclass
class Timings:
    """Seconds spent in the phases of a job."""

    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def phase(self, name: str) -> Iterator[None]:
        start = time.perf_counter()
        yield
        self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - start

    def rows(self, spark: SparkSession) -> DataFrame:
        """``phase, seconds`` for the metrics tables."""
        return spark.createDataFrame(list(self.seconds.items()), "phase string, seconds double")


# --- scan -----------------------------------------------------------------------


def scan_dataset(
    spark: SparkSession,
    root: str,
    out: str,
    *,
    bucket: str,
    prefix: str,
    decode: bool = True,
) -> DataFrame:
    """List, validate and summarise a prefix; write JSON lines and record the scan.

    Gives the summary row.  With ``decode`` the sizes come from Spark's image decoder.
    """
    found = scanning.validate_bytes(objects.read_objects(spark, root, images_only=True))
    if decode:
        found = scanning.add_decoded_size(found, image_sizes(spark, root))
    metadata = stage(found, "scan")
    key = spark.range(1).select(metadata_key(F.lit(prefix)).alias("key")).first()["key"]
    base = out.rstrip("/")
    tables.write_jsonl(metadata, f"{base}/{key}")
    summary = scanning.scan_summary(metadata)
    entry = summary.select(
        F.lit(bucket).alias("source_bucket"),
        F.lit(prefix).alias("source_prefix"),
        F.lit(key).alias("metadata_key"),
        F.current_timestamp().alias("at"),
        "total",
        "corrupted",
    )
    append_scan(entry, f"{base}/metadata/registry")
    return summary


# --- shard ----------------------------------------------------------------------


def shard_dataset(
    listing: DataFrame,
    prefix: str,
    out: str,
    *,
    splits: Sequence[str | None] = (None,),
    extensions: Iterable[str] | None = None,
    shard_size: int | None = None,
    num_shards: int | None = None,
    order: str = "key",
) -> DataFrame:
    """Number the images of a listing (``path, key``) and write tar shards and manifest.

    Each split gets its own shard names and class ids.  The tasks that write a shard
    read its images themselves, so only the manifest is shuffled.  Gives the manifest.
    """
    parts = [
        _shard_split(listing, prefix, split, extensions, shard_size, num_shards, order) for split in splits
    ]
    numbered = stage(reduce(DataFrame.unionByName, parts), "sharded")
    manifest = numbered.drop("path")
    tables.write_manifest(manifest, out)
    rows = numbered.select("shard", "sample_idx", F.col("__key__").alias("key"), "cls_idx", "path")
    shards = numbered.select("shard").distinct().count()
    tarshards.write_files_as_shards(tarshards.place_by_shard(rows, shards), out)
    return manifest


def shard_from_config(spark: SparkSession, source, **given) -> DataFrame:
    """Shard a dataset as a config says, every split of it; gives the manifest.

    With ``upload_uri`` the shards and the manifest are copied there as well.
    """
    config = shard_config(source, **given)
    out = config["output_dir"]
    manifest = shard_dataset(
        objects.list_objects(spark, config["input_root"]),
        "",
        out,
        splits=config["splits"] or (None,),
        extensions=config["extensions"],
        shard_size=config["shard_size"],
        num_shards=config["num_shards"],
    )
    if config["upload_uri"]:
        key = F.col("key")
        made = objects.list_objects(spark, out)
        made = made.filter(key.endswith(".tar") | (key.startswith("metadata/") & key.endswith(".parquet")))
        objects.copy_objects(made, config["upload_uri"])
    return manifest


def _shard_split(listing, prefix, split, extensions, shard_size, num_shards, order) -> DataFrame:
    samples = labelled_samples(listing, prefix, split=split, extensions=extensions)
    total = samples.count() if num_shards is not None else 0
    size = shard_size_for(total, num_shards, shard_size)
    return with_class_ids(manifest_of(samples, size, split=split, order=order, keep=["path"]), size)


# --- transform --------------------------------------------------------------------


def read_ledger(spark: SparkSession, path: str, job: str | None = None) -> DataFrame:
    """Work that needs no further run, done or with an ``error``; none where the ledger does not exist yet."""
    try:
        done = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != tables.NO_PATH:
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return done if job is None else done.filter(F.col("job_id") == job)


def append_to_ledger(done: DataFrame, path: str, job: str, run: str) -> None:
    columns = {f.name: F.lit(None).cast(f.dataType) for f in LEDGER_SCHEMA}
    columns |= {c: F.col(c) for c in done.columns if c in columns}
    columns |= {"job_id": F.lit(job), "run_id": F.lit(run), "at": F.current_timestamp()}
    done.select(*[columns[n].alias(n) for n in columns]).write.mode("append").parquet(path)


def job_name(bucket: str, prefix: str) -> str:
    spark = SparkSession.getActiveSession()
    name = F.concat(F.lit(bucket + "_"), flat_prefix(F.lit(prefix)))
    return spark.range(1).select(name.alias("n")).first()["n"]


def run_transform(
    spark: SparkSession, root: str, steps: Sequence[Step], out: str, *, job: str, sharded: bool | None = None
) -> Timings:
    """Transform a prefix, flat or sharded; the layout is looked up where not given."""
    listing = None
    if sharded is None:
        listing = objects.list_objects(spark, root)
        sharded = detect_sharded(listing).first()["is_sharded"]
    if sharded:
        return transform_sharded(spark, root, steps, out, job=job, listing=listing)
    return transform_flat(spark, root, steps, out, job=job)


def transform_flat(
    spark: SparkSession,
    root: str,
    steps: Sequence[Step],
    out: str,
    *,
    job: str,
    decoder: str | None = None,
    dest_prefix: str = "",
    wave: int = WAVE_FILES,
) -> Timings:
    """Transform the images below ``root`` that are not done yet, ``wave`` files at a time.

    Pending work is the listing without the ledger, so late and old files are found as
    well.  ``decoder`` is "python", "spark" or what the executors have.  An image that
    cannot be decoded gets a ledger row that says why; where no decoder here knows
    its format, it stays pending and the job fails once all the others are done.
    """
    timings, base = Timings(), out.rstrip("/")
    ledger_path = f"{base}/ledger"
    with timings.phase("list"):
        listed = filter_images(objects.list_objects(spark, root))
        todo = led.pending_work(listed, read_ledger(spark, ledger_path, job), ["key"])
        numbered = number_rows(todo, ["key"])
    unknown: set[str] = set()
    for part in waves(numbered, wave):
        run = uuid.uuid4().hex
        with timings.phase("process"):
            placed = objects.spread_by_bytes(part, "size_bytes", ["key"])
            found = decode_content(objects.fetch_content(placed), decoder=decoder)
            image = kernel_column([*steps, ToLevels()], F.col("image"), F.col("key"), levels=True, form="bytes")
            dest = dest_key(F.lit(dest_prefix), F.col("key"))
            written = f"{base}/images/run={run}"
            found.select("key", image.alias("image"), dest.alias("dest"), "format").write.parquet(written)
        with timings.phase("ledger"):
            outcome = spark.read.parquet(written)
            lost = F.col("image").isNull()
            outcome = outcome.select("key", F.when(lost, _why(F.col("format"))).alias("error"), lost.alias("lost"), "format")
            unknown |= _unknown_formats(outcome)
            finished = outcome.filter(~F.col("lost") | _decodable(F.col("format")))
            append_to_ledger(finished.select("key", "error"), ledger_path, job, run)
    _check_formats(unknown)
    return timings


def _decodable(fmt: Column) -> Column:
    """Formats every decoder knows, and bytes of no known format, which none ever will."""
    return fmt.isNull() | fmt.isin(*DECODED_FORMATS)


def _why(fmt: Column) -> Column:
    return F.concat(F.lit(f"{scanning.UNDECODABLE}: "), F.coalesce(fmt, F.lit("no known format")))


def _unknown_formats(outcome: DataFrame) -> set[str]:
    """Formats of ``lost, format`` rows no decoder here knows; formats are few."""
    left = outcome.filter(F.col("lost") & ~_decodable(F.col("format"))).select("format").distinct()
    return {r["format"] for r in left.collect()}


def _check_formats(unknown: set[str]) -> None:
    if unknown:
        raise ValueError(f"no decoder is installed for {', '.join(sorted(unknown))}; these images stay pending")


def waves(numbered: DataFrame, size: int, pos: str = "pos") -> Iterator[DataFrame]:
    """Portions of a numbered table; the driver sees only how many there are."""
    top = numbered.agg(F.max(pos).alias("top")).first()["top"]
    for start in range(0, 0 if top is None else top + 1, size):
        yield numbered.filter(F.col(pos).between(start, start + size - 1))


def read_transformed(spark: SparkSession, out: str) -> DataFrame:
    """``key, image, dest`` of transformed images; a run counts once its ledger rows exist."""
    base = out.rstrip("/")
    images = spark.read.parquet(f"{base}/images").filter(F.col("image").isNotNull())
    runs = read_ledger(spark, f"{base}/ledger").select(F.col("run_id").alias("run")).distinct()
    return images.join(runs, "run", "left_semi").drop("run", "format")


def read_errors(spark: SparkSession, out: str, job: str | None = None) -> DataFrame:
    """Ledger rows of work that cannot be done, with the reason."""
    return read_ledger(spark, f"{out.rstrip('/')}/ledger", job).filter(F.col("error").isNotNull())


def transform_sharded(
    spark: SparkSession,
    root: str,
    steps: Sequence[Step],
    out: str,
    *,
    job: str,
    wave: int = WAVE_SHARDS,
    listing: DataFrame | None = None,
) -> Timings:
    """Transform a sharded dataset: one output tar per input tar with pending samples.

    A shard with any pending sample is rebuilt whole.  Samples are joined with the
    manifest on shard and place while they are index rows; reading, transforming and
    writing then happen in the one task that owns the shard.  After every ``wave``
    shards the ledger gets a row per pending sample: done, or with the reason why not,
    as for a broken image, one without an image member, or a manifest row without a
    sample.  Samples of a format no decoder here knows stay pending, and the job fails
    once all the others are done.  A shard whose tar is not there stays pending.
    """
    timings, base = Timings(), out.rstrip("/")
    ledger_path = f"{base}/ledger"
    with timings.phase("metadata_load"):
        manifest = tables.read_manifest(spark, root)
        pending = led.pending_work(manifest, read_ledger(spark, ledger_path, job), ["shard", "sample_idx"])
        found = objects.list_objects(spark, root) if listing is None else listing
        files = tarshards.shard_files(found)
        present = led.needed_shards(pending).join(files.select("shard"), "shard", "left_semi")
        needed = number_rows(present, ["shard"])
        todo = stage(pending.select("shard", "sample_idx", F.col("__key__").alias("key")), "pending")
    direct = codec_installed(spark)
    size = wave if direct else max(1, min(wave, WAVE_FILES // DEFAULT_SHARD_SIZE))
    rows = manifest.select("shard", "sample_idx")
    unknown: set[str] = set()
    for part in waves(needed, size):
        with timings.phase("index"):
            index = tarshards.index_shards(files.join(part, "shard", "left_semi"))
            known = led.join_manifest(index, rows)
            wanted = stage(known.filter(tarshards.has_place(F.col("places"))), "wanted")
        with timings.phase("process"):
            count = part.count()
            if direct:
                samples = _transformed_samples(tarshards.fetch_members(tarshards.place_by_shard(wanted, count)), steps)
            else:
                samples = _transformed_samples(tarshards.fetch_members(tarshards.spread_reads(wanted)), steps)
                samples = tarshards.place_by_shard(stage(samples, "transformed"), count)
            written = tarshards.write_placed_shards(samples, base)
        with timings.phase("ledger"):
            here = todo.join(part.select("shard"), "shard", "left_semi")
            lost = written.select("shard", F.explode("skipped").alias("sample_idx"))
            outcome = stage(_outcome(here, known, wanted, lost), "outcome")
            unknown |= _unknown_formats(outcome)
            finished = outcome.filter(~F.col("lost") | _decodable(F.col("format")))
            append_to_ledger(finished.select("shard", "sample_idx", "key", "error"), ledger_path, job, uuid.uuid4().hex)
    _check_formats(unknown)
    return timings


def _outcome(pending: DataFrame, known: DataFrame, wanted: DataFrame, lost: DataFrame) -> DataFrame:
    """What became of each pending sample: ``shard, sample_idx, key, error, lost, format``.

    The formats of the samples lost, which are few, are read again from their tars.
    """
    on = ["shard", "sample_idx"]
    again = tarshards.fetch_members(tarshards.spread_reads(stage(wanted.join(lost, on, "left_semi"), "lost")))
    formats = again.select(*on, image_format(_image_member(F.col("members"))).alias("format"), F.lit(True).alias("lost"))
    sides = known.select(*on, tarshards.has_place(F.col("places")).alias("image"))
    found = pending.join(sides, on, "left").join(formats, on, "left")
    reason = (
        F.when(F.col("image").isNull(), F.lit("no sample at this place of the shard"))
        .when(~F.col("image"), F.lit("no image member"))
        .when(F.col("lost"), _why(F.col("format")))
    )
    return found.select(*on, "key", reason.alias("error"), F.coalesce("lost", F.lit(False)).alias("lost"), "format")


def audit_shards(spark: SparkSession, root: str) -> DataFrame:
    """``shard, sample_idx, side``: manifest rows without a sample, and samples without a manifest row."""
    index = tarshards.index_shards(tarshards.list_shard_files(spark, root))
    return led.reconcile_keys(index, tables.read_manifest(spark, root), ["shard", "sample_idx"])


def _image_member(members: Column) -> Column:
    return F.coalesce(*[members[m] for m in tarshards.IMAGE_MEMBERS])


def _transformed_samples(fetched: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """``shard, sample_idx, key, members`` of transformed samples; null members where decoding failed."""
    members = F.col("members")
    narrow = fetched.select(
        "shard", "sample_idx", "key", _image_member(members).alias("content"), members["cls"].alias("_cls")
    )
    image = kernel_column([*steps, ToLevels()], F.col("image"), F.col("key"), levels=True, form="png")
    done = decode_content(narrow).select("shard", "sample_idx", "key", "_cls", image.alias("_png"))
    both = F.create_map(F.lit("png"), F.col("_png"), F.lit("cls"), F.col("_cls"))
    present = F.when(F.col("_png").isNotNull(), F.map_filter(both, lambda _, data: data.isNotNull()))
    return done.select("shard", "sample_idx", "key", present.alias("members"))


# --- keyed datasets and training views ------------------------------------------------


def convert_keyed(
    listing: DataFrame,
    prefix: str,
    out: str,
    *,
    split: str | None = None,
    extensions: Iterable[str] | None = None,
    present: DataFrame | None = None,
    order: str = "parts",
    key_width: int = 10,
) -> DataFrame:
    """Labelled listing (``path, key, size_bytes``) to a keyed dataset; gives the manifest row.

    Class ids follow label order, and an unlabelled sample gets 0.  ``present`` names
    the objects that still exist; the rest is left out before numbering.
    """
    samples = labelled_samples(listing, prefix, split=split, extensions=extensions)
    ids = label_ids_sorted(samples)
    if present is not None:
        samples = skip_missing(samples, present)
    coded = encode_labels(samples, ids, missing=0)
    source = split_base(prefix, split).rstrip("/")
    return keyed.write_keyed(
        coded, out, ids, source=source, key_width=key_width, order=listing_order(order)
    )


def image_folder(
    listing: DataFrame, prefix: str, *, split: str | None = None, extensions: Iterable[str] | None = None
) -> DataFrame:
    """A labelled folder as a training table; class ids follow the sorted folder names."""
    samples = labelled_samples(listing, prefix, split=split, extensions=extensions)
    return encode_labels(samples, label_ids_sorted(samples), missing=0)


def _decoded_records(records: DataFrame) -> DataFrame:
    """Records with their image decoded; the job fails at one that cannot be.

    Without a codec on the executors, records are decoded ``WAVE_FILES`` at a time.
    """
    spark = records.sparkSession
    if codec_installed(spark):
        done = decode_content(records.withColumnRenamed("image", "content"))
    else:
        top = records.agg(F.max("idx").alias("top")).first()["top"] or 0
        parts = [
            decode_content(records.filter(F.col("idx").between(at, at + WAVE_FILES - 1)).withColumnRenamed("image", "content"))
            for at in range(0, top + 1, WAVE_FILES)
        ]
        done = reduce(DataFrame.unionByName, parts)
    return done.withColumn("image", or_fail(F.col("image"), F.col("key"))).drop("format")


def _training_image(steps: Sequence[Step]) -> Column:
    form = "floats" if steps else "bytes"
    return kernel_column(steps, F.col("image"), F.col("key"), levels=True, form=form)


def read_for_training(spark: SparkSession, out: str, steps: Sequence[Step] = ()) -> DataFrame:
    """``idx, key, label, image`` of a keyed dataset, decoded and transformed.

    A record that cannot be decoded fails the job.
    """
    records = _decoded_records(keyed.read_keyed(spark, out))
    return records.withColumn("image", _training_image(steps)).select("idx", "key", "label", "image")


def training_batches(
    spark: SparkSession,
    out: str,
    batch_size: int,
    steps: Sequence[Step] = (),
    *,
    epoch: int = 0,
    seed: int = 0,
    pad_last: bool = False,
    max_steps: int | None = None,
) -> DataFrame:
    """Shuffled batches of a keyed dataset: ``epoch, batch_id, batch_pos, idx, key, label, image``.

    A record's batch follows from its index by a keyed permutation, so encoded images move
    once, to their batch, without a sort or a join that works out the order.  There they
    are transformed; each batch lies in order in one partition.  A record that cannot be
    decoded fails the job.
    """
    data, total = keyed.read_keyed(spark, out), keyed.dataset_length(spark, out)

    def planned(records: DataFrame, pad: bool = pad_last) -> DataFrame:
        rows = epoch_batches(records, batch_size, epoch=epoch, seed=seed, total=total, pad_last=pad)
        return rows if max_steps is None else first_batches(rows, max_steps)

    def dealt(records: DataFrame) -> DataFrame:
        return planned(records).repartition("batch_id").sortWithinPartitions("batch_id", "batch_pos")

    if codec_installed(spark):
        rows = _decoded_records(dealt(data))
    else:
        rows = dealt(_decoded_records(planned(data, pad=False).select(*data.columns)))
    columns = ["epoch", "batch_id", "batch_pos", "idx", "key", "label", "image"]
    return rows.withColumn("image", _training_image(steps)).select(*columns)
