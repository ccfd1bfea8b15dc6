"""Objects under a prefix: listing, reading and writing.

A listing is any DataFrame with ``key`` and ``size_bytes``.  For a store of very many
objects, read the store's inventory table instead of listing it: every operator
takes that as well.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplelake.functions.paths import IMAGE_EXTENSIONS
from samplelake.operators.listing import filter_objects
from samplelake.sources.files import UNFINISHED, Files, qualified, split_path
from samplelake.staging import stage

FETCH_BYTES = 16 << 20
LISTING_ROWS = 10_000
LISTING_TASKS = 256
TASK_BYTES = 256 << 20
MOST_TASKS = 100_000


def key_under(path: Column, root: str) -> Column:
    """Key of a file relative to ``root``, whatever way its scheme is spelled."""
    inner = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    base = split_path(root)[2].rstrip("/") + "/"
    return F.substring(inner, len(base) + 1, 1 << 30)


def file_of(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def _walk(files: Files, folders: list[str], stop_at: int | None) -> Iterator[pa.RecordBatch]:
    """Entries below some folders, one folder at a time.

    With ``stop_at``, the walk ends once that many folders wait, and names them.
    """
    waiting = deque(folders)
    while waiting and (stop_at is None or len(waiting) < stop_at):
        folder = waiting.popleft()
        found = [(path, size) for path, size in files.entries(folder) if not file_of(path).startswith(UNFINISHED)]
        waiting.extend(path for path, size in found if size is None)
        yield from _entries([f for f in found if f[1] is not None], False)
    yield from _entries([(path, 0) for path in waiting], True)


def _entries(rows: list, folder: bool) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(rows), LISTING_ROWS):
        paths, sizes = zip(*rows[start : start + LISTING_ROWS])
        flags = pa.array([folder] * len(paths))
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths), pa.array(sizes, pa.int64()), flags], ["path", "size_bytes", "folder"]
        )


def _walker(stop_at: int | None):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        for batch in batches:
            yield from _walk(files, batch.column(0).to_pylist(), stop_at)

    return walk


def list_objects(spark: SparkSession, root: str, extensions: Iterable[str] | None = None) -> DataFrame:
    """``path, key, size_bytes`` of all objects below ``root``, empty ones included.

    One task finds enough folders to share; the rest of the listing is done by tasks,
    folder by folder, and never passes through the driver.  The listing is kept as a
    table, so that its users do not walk the store again.
    """
    schema = "path string, size_bytes long, folder boolean"
    root = qualified(spark, root)
    tasks = min(LISTING_TASKS, spark.sparkContext.defaultParallelism)
    top = spark.range(0, 1, 1, 1).select(F.lit(root).alias("path"))
    first = stage(top.mapInArrow(_walker(2 * tasks), schema), "folders")
    folders = first.filter("folder").select("path").repartition(tasks, "path")
    found = first.filter("NOT folder").unionByName(folders.mapInArrow(_walker(None), schema))
    listed = found.select("path", key_under(F.col("path"), root).alias("key"), "size_bytes")
    return filter_objects(stage(listed, "listing"), extensions)


def read_objects(spark: SparkSession, root: str, images_only: bool = False) -> DataFrame:
    """Every listed object below ``root`` with its bytes, whatever its name, dealt to tasks by size."""
    listed = list_objects(spark, root, IMAGE_EXTENSIONS if images_only else None)
    return fetch_content(spread_by_bytes(listed, "size_bytes", ["key"]))


def read_object(spark: SparkSession, root: str, key: str) -> DataFrame:
    """One object with its bytes; only its own path is opened."""
    path = f"{root.rstrip('/')}/{key}"
    one = spark.read.format("binaryFile").load(path)
    return one.select("path", F.lit(key).alias("key"), F.col("length").alias("size_bytes"), "content")


def tasks_for(size_bytes: int, task_bytes: int = TASK_BYTES) -> int:
    """Tasks needed so that each reads about ``task_bytes``, up to what a driver can track."""
    return min(MOST_TASKS, max(1, -(-size_bytes // task_bytes)))


def spread_by_bytes(rows: DataFrame, size: str, order: list[str]) -> DataFrame:
    """Range-partition narrow rows by the bytes they stand for, sorted in each task.

    The adaptive planner sees only the small rows and would merge them into a few
    huge reads, so the number of tasks is set from the sum of the sizes.
    """
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    n = max(tasks_for(total), min(rows.sparkSession.sparkContext.defaultParallelism, 8))
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order)


def fetch_content(rows: DataFrame, path: str = "path", name: str = "content") -> DataFrame:
    """Add the bytes of each row's file, read by the task that holds the row."""
    names = rows.columns
    schema = rows.withColumn(name, F.lit(b"")).schema

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        for batch in batches:
            start, held, contents = 0, 0, []
            paths = batch.column(names.index(path)).to_pylist()
            for row, p in enumerate(paths):
                contents.append(files.read(p))
                held += len(contents[-1])
                if held >= FETCH_BYTES or row == len(paths) - 1:
                    part = batch.slice(start, row + 1 - start)
                    data = pa.array(contents, pa.binary())
                    yield pa.RecordBatch.from_arrays([*part.columns, data], [*names, name])
                    start, held, contents = row + 1, 0, []

    return rows.mapInArrow(fetch, schema)


def copy_objects(listing: DataFrame, root: str) -> DataFrame:
    """Copy listed objects below ``root`` under the same keys; gives what was written."""
    placed = spread_by_bytes(listing.select("path", "key", "size_bytes"), "size_bytes", ["key"])
    return write_objects(fetch_content(placed), root)


def write_objects(rows: DataFrame, root: str, key: str = "key", content: str = "content") -> DataFrame:
    """Write each row's bytes below ``root``; gives ``key, size_bytes`` of what was written."""
    base = qualified(rows.sparkSession, root).rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        for batch in batches:
            keys, sizes = batch.column(0), []
            for k, data in zip(keys, batch.column(1)):
                buffer = data.as_buffer()
                files.write(f"{base}/{k.as_py()}", buffer)
                sizes.append(buffer.size)
            yield pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64())], ["key", "size_bytes"])

    receipts = rows.select(F.col(key).alias("key"), F.col(content).cast("binary")).mapInArrow(
        write, "key string, size_bytes long"
    )
    return stage(receipts, "written")
