"""Tar shards: samples are runs of members that share a name up to its first dot.

Neighbouring samples of one name, as from two class folders, are told apart by a
member that comes again.  A dot in a sample key is written as ``_``; the manifest
keeps the key itself, and samples are joined with it by their place.

Shards are read in two steps.  An index lists each sample's members with their place
in the tar; headers are read by seeking, contents are skipped.  Joins and filters run
on that index, and only then are the wanted bytes read, in even portions, so a very
large tar is shared by many tasks and no image bytes cross a shuffle.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplelake.functions.paths import file_name
from samplelake.functions.values import class_to_bytes
from samplelake.operators.listing import filter_objects
from samplelake.sources.files import Files, qualified
from samplelake.sources.objects import FETCH_BYTES, TASK_BYTES, list_objects, tasks_for
from samplelake.staging import stage

INDEX_SCHEMA = (
    "shard string, path string, sample_idx long, key string, offset long, size long, "
    "places array<struct<ext:string,offset:long,size:long>>"
)
IMAGE_MEMBERS = ("jpg", "jpeg", "png")
INDEX_ROWS = 5000
SLICE_ROWS = 512
SHARDS_PER_TASK = 25
TARS_PER_TASK = 4


def list_shard_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, key, size_bytes, shard`` of the tars below ``root``."""
    return shard_files(list_objects(spark, root))


def shard_files(listing: DataFrame) -> DataFrame:
    """The tars of a listing, with their file names as ``shard``.

    Manifests name shards by file name, so two tars of one name are refused.
    """
    tars = filter_objects(listing, [".tar"]).withColumn("shard", file_name(F.col("key")))
    twice = tars.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"{twice['n']} tars are named {twice['shard']}, one of them {twice['key']}")
    return tars


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that the Python objects made of them stay few in batches of any size."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _split_member(name: str) -> tuple[str, str]:
    folder, _, base = name.rpartition("/")
    stem, dot, ext = base.partition(".")
    key = f"{folder}/{stem}" if folder else stem
    return key, ext.lower() if dot and stem else ""


def _samples(handle) -> Iterator[tuple[str, list[dict]]]:
    """Key and member places of each sample, in tar order."""
    key, places = None, []
    with tarfile.open(fileobj=handle, mode="r:") as tar:
        for member in tar:
            tar.members.clear()  # headers already seen are not needed again
            name, ext = _split_member(member.name)
            if not member.isfile() or not ext:
                continue
            if places and (name != key or any(p["ext"] == ext for p in places)):
                yield key, places
                places = []
            key = name
            places.append({"ext": ext, "offset": member.offset_data, "size": member.size})
    if places:
        yield key, places


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = Files()
    for batch in batches:
        for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            with files.open(path) as handle:
                for idx, (key, places) in enumerate(_samples(handle)):
                    rows.append(
                        {
                            "shard": shard,
                            "path": path,
                            "sample_idx": idx,
                            "key": key,
                            "offset": places[0]["offset"],
                            "size": sum(p["size"] for p in places),
                            "places": places,
                        }
                    )
                    if len(rows) == INDEX_ROWS:
                        yield from _index_batch(rows)
                        rows = []
            yield from _index_batch(rows)


def _index_batch(rows: list[dict]) -> list[pa.RecordBatch]:
    place = pa.struct([("ext", pa.string()), ("offset", pa.int64()), ("size", pa.int64())])
    schema = pa.schema(
        [
            ("shard", pa.string()),
            ("path", pa.string()),
            ("sample_idx", pa.int64()),
            ("key", pa.string()),
            ("offset", pa.int64()),
            ("size", pa.int64()),
            ("places", pa.list_(place)),
        ]
    )
    return [pa.RecordBatch.from_pylist(rows, schema)] if rows else []


def index_shards(shard_files: DataFrame) -> DataFrame:
    """One row per sample of the given tars, with the places of its members.

    Tars are dealt to tasks by number, wherever their listing came from: headers are
    read by seeking, so a tar costs by its samples and not by its bytes.
    """
    files = shard_files.select("shard", "path")
    n = max(1, -(-files.count() // TARS_PER_TASK))
    return stage(files.repartition(n, "path").mapInArrow(_index, INDEX_SCHEMA), "index")


def has_member(members: Column, names: tuple[str, ...] = IMAGE_MEMBERS) -> Column:
    """True where a sample has a member with one of the names."""
    return F.arrays_overlap(F.map_keys(members), F.array(*map(F.lit, names)))


def has_place(places: Column, names: tuple[str, ...] = IMAGE_MEMBERS) -> Column:
    """The same test on the index, before any bytes are read."""
    return F.exists(places, lambda p: p["ext"].isin(*names))


def fetch_members(index: DataFrame) -> DataFrame:
    """Replace ``places`` by ``members``, a map from member name to bytes."""
    names = [c for c in index.columns if c != "places"]
    at_path = names.index("path")
    ordered = index.select(*names, "places")
    schema = ordered.select(*names, F.create_map(F.lit(""), F.lit(b"")).alias("members")).schema

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, handle, opened = Files(), None, None
        for batch in _portions(batches):
            start, held, members = 0, 0, []
            paths, places = batch.column(at_path).to_pylist(), batch.column(len(names)).to_pylist()
            for row, (path, wanted) in enumerate(zip(paths, places)):
                if path != opened:
                    if handle is not None:
                        handle.close()
                    handle, opened = files.open(path), path
                found = [(p["ext"], files.read_range(handle, p["offset"], p["size"])) for p in wanted]
                members.append(found)
                held += sum(len(b) for _, b in found)
                if held >= FETCH_BYTES or row == len(paths) - 1:
                    part = batch.slice(start, row + 1 - start)
                    maps = pa.array(members, pa.map_(pa.string(), pa.binary()))
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], maps], [*names, "members"])
                    start, held, members = row + 1, 0, []
        if handle is not None:
            handle.close()

    return ordered.mapInArrow(fetch, schema)


def spread_reads(index: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Give every task about ``task_bytes`` of neighbouring samples, whatever the tar sizes."""
    total = index.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    n = max(tasks_for(total, task_bytes), min(index.sparkSession.sparkContext.defaultParallelism, 8))
    block = F.floor(F.col("offset") / F.lit(task_bytes))
    return index.repartition(n, F.col("shard"), block).sortWithinPartitions("shard", "sample_idx")


def read_shards(spark: SparkSession, root: str, shards: DataFrame | None = None) -> DataFrame:
    """``shard, path, sample_idx, key, offset, size, members`` of the samples below ``root``.

    With ``shards`` given, other tars are never opened.
    """
    found = list_shard_files(spark, root)
    if shards is not None:
        found = found.join(shards.select("shard"), "shard", "left_semi")
    return fetch_members(spread_reads(index_shards(found)))


def sample_members(content: Column, class_id: Column | None = None, ext: str = "jpg") -> Column:
    """Members of a sample: the image bytes and, where known, the class id."""
    image = F.create_map(F.lit(ext), content)
    if class_id is None:
        return image
    coded = F.map_concat(image, F.create_map(F.lit("cls"), class_to_bytes(class_id)))
    return F.when(class_id.isNull(), image).otherwise(coded)


def place_by_shard(rows: DataFrame, n_shards: int, order: str = "shard") -> DataFrame:
    """Whole shards to tasks, samples in order.  Do this while the rows are still narrow."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n = max(1, min(n_shards, max(2 * cores, -(-n_shards // SHARDS_PER_TASK))))
    return rows.repartitionByRange(n, order).sortWithinPartitions(order, "sample_idx")


RECEIPTS = "shard string, samples long, size_bytes long, skipped array<long>"


class _Tars:
    """The tars one task writes, one at a time: under a temporary name, renamed when complete."""

    def __init__(self, base: str):
        self.base, self.files, self.receipts = base, Files(), []
        self.shard = self.tar = None

    def add(self, shard: str, place: int, key: str, members: list[tuple[str, bytes]] | None) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.tar, self.count, self.skipped = shard, None, 0, []
        if members is None:
            self.skipped.append(place)
            return
        if self.tar is None:
            self.out, self.part = self.files.start(f"{self.base}/{shard}")
            self.tar = tarfile.open(fileobj=self.out, mode="w|", format=tarfile.PAX_FORMAT)
        for ext, data in members:
            info = tarfile.TarInfo(f"{key.replace('.', '_')}.{ext}")
            info.size = len(data)
            self.tar.addfile(info, io.BytesIO(data))
        self.count += 1

    def close(self) -> None:
        if self.shard is None:
            return
        size = 0
        if self.tar is not None:
            self.tar.close()
            size = self.out.tell()
            self.out.close()
            self.files.finish(f"{self.base}/{self.shard}", self.part)
        self.receipts.append((self.shard, self.count, size, self.skipped))

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.close()
        if self.receipts:
            shards, samples, sizes, left = zip(*self.receipts)
            columns = [pa.array(shards), pa.array(samples), pa.array(sizes), pa.array(left, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "samples", "size_bytes", "skipped"])


def write_placed_shards(rows: DataFrame, root: str) -> DataFrame:
    """Write one tar per shard from rows already placed by :func:`place_by_shard`.

    Rows have ``shard, sample_idx, key, members``.  A task writes one tar at a time,
    sample by sample, so a repeated task leaves the same file.  A sample without members
    is not written.  Gives ``shard, samples, size_bytes, skipped`` of every shard: the
    places of the samples left out, and no tar where that is all of them.
    """
    base = qualified(rows.sparkSession, root).rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tars = _Tars(base)
        for batch in batches:
            for shard, place, key, members in zip(*[batch.column(i) for i in range(4)]):
                tars.add(shard.as_py(), place.as_py(), key.as_py(), members.as_py())
        yield from tars.batches()

    narrow = rows.select("shard", F.col("sample_idx").cast("long"), "key", "members")
    return stage(narrow.mapInArrow(write, RECEIPTS), "shards")


def write_files_as_shards(rows: DataFrame, root: str, ext: str = "jpg") -> DataFrame:
    """As :func:`write_placed_shards`, from placed rows ``shard, sample_idx, key, path, cls_idx``.

    The task that writes a tar reads its files, so no image bytes pass through the JVM.
    """
    base = qualified(rows.sparkSession, root).rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tars = _Tars(base)
        for batch in _portions(batches):
            for shard, place, key, path, cls in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                members = [(ext, tars.files.read(path))]
                tars.add(shard, place, key, members if cls is None else [*members, ("cls", cls)])
        yield from tars.batches()

    coded = F.when(F.col("cls_idx").isNotNull(), class_to_bytes(F.col("cls_idx"))).alias("cls")
    narrow = rows.select("shard", F.col("sample_idx").cast("long"), "key", "path", coded)
    return stage(narrow.mapInArrow(write, RECEIPTS), "shards")


def write_shards(rows: DataFrame, root: str, n_shards: int | None = None) -> DataFrame:
    """Write ``shard, sample_idx, key, members`` as tars; the members are shuffled once."""
    if n_shards is None:
        n_shards = rows.agg(F.approx_count_distinct("shard").alias("n")).first()["n"]
    return write_placed_shards(place_by_shard(rows, n_shards), root)
