"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A window is a run of words of a benchmark item; an item with fewer words is one window.
Windows of one length share a shift table and suffix buckets.  The table is keyed by a
block of two words and holds how far the search may jump when a position's block ends
there; blocks of no window jump nearly a whole window.  A jump of nothing leads to the
bucket of the block, whose windows are compared word for word.

The benchmark is a stated query set.  Its texts are broadcast, and tasks compile them in
blocks of bounded size, one at a time; documents pass through once and never shuffle.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import ASCII_UPPER, extended, keyed, schema_of, slices, take

WINDOW = 10
# Bytes of benchmark text compiled at a time (some 150 times as much memory), and bytes of
# rows a task holds while one block after the other is compiled and searched for.
BLOCK_BYTES = 1 << 20
HELD_BYTES = 64 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = re.compile(WORD)
_LOWER = str.maketrans(ASCII_UPPER, ASCII_UPPER.lower())

# Per window length: jump by block, jump of other blocks, (window, items) by suffix block.
Tables = dict[int, tuple[dict, int, dict]]


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER)) if text else []


def compile_windows(items: list[tuple[str | None, list[str]]], window: int = WINDOW) -> Tables:
    """Wu-Manber tables of the windows of ``(item_id, words)``."""
    named: dict[int, dict[tuple[str, ...], set[str]]] = {}
    for item, words in items:
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            owners = named.setdefault(size, {}).setdefault(tuple(words[at : at + size]), set())
            if item is not None:
                owners.add(item)
    tables: Tables = {}
    for size, windows in named.items():
        block = min(2, size)
        jump: dict[tuple[str, ...], int] = {}
        bucket: dict[tuple[str, ...], list] = {}
        for found, owners in windows.items():
            for end in range(block, size + 1):
                key = found[end - block : end]
                jump[key] = min(jump.get(key, size), size - end)
            bucket.setdefault(found[size - block :], []).append((list(found), sorted(owners)))
        tables[size] = (jump, size - block + 1, bucket)
    return tables


def search(words: list[str], tables: Tables) -> Iterator[tuple[int, int, list[str]]]:
    """``start, end, items`` of every occurrence of a window."""
    count = len(words)
    for size, (jump, most, bucket) in tables.items():
        at = size
        while at <= count:
            block = (words[at - 2], words[at - 1]) if size > 1 else (words[at - 1],)
            step = jump.get(block, most)
            if step:
                at += step
                continue
            for found, owners in bucket[block]:
                if words[at - size : at] == found:
                    yield at - size, at, owners
            at += 1


def covered(spans: np.ndarray) -> int:
    """Places inside any of the spans ``start, end``."""
    if not len(spans):
        return 0
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reached = np.concatenate(([0], np.maximum.accumulate(spans[:, 1])[:-1]))
    return int(np.maximum(spans[:, 1] - np.maximum(spans[:, 0], reached), 0).sum())


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items ``item_id, text`` in blocks of bounded text; one item is never cut."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        held.append((row.item_id, row.text))
        size += len((row.text or "").encode())
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    text: str = "text",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``n_words, n_hit, items, items_sha256, hit_spans`` to rows with a text column.

    ``benchmark`` has ``item_id, text``.  A null or empty text has no words; an item
    without words has no window; an item without id marks words and is not counted; items
    of one id count once.  Rows of either table may repeat; each row is judged by itself.
    An empty benchmark leaves every count zero.  Columns in ``drop`` end here.  ``hit_spans`` holds word places of
    occurrences, two ints each (start, end), as bytes.

    Texts of the benchmark are broadcast, and a task holds the tables of one block of them
    at a time: where there are several, it takes rows up to ``HELD_BYTES`` and compiles the
    blocks in turn for them, which costs little beside the search.
    """
    blocks = list(benchmark_blocks(take(benchmark, item_id="item_id", text="text"), block_bytes))
    shared = docs.sparkSession.sparkContext.broadcast(blocks)
    added = "n_words long, n_hit long, items array<string>, items_sha256 string, hit_spans binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        only = _compiled(blocks[0], window) if len(blocks) == 1 else None
        for held in portions(slices(batches), HELD_BYTES if len(blocks) > 1 else 0):
            rows = [batch.column(text) for batch in held]
            found = [[(array("i"), set()) for _ in column] for column in rows]
            counts = [[0] * len(column) for column in rows]
            for block in blocks or [[]]:
                tables = _compiled(block, window) if only is None else only
                for column, hits, count in zip(rows, found, counts):
                    for row, (value, (spans, owners)) in enumerate(zip(column, hits)):
                        words = words_of(value.as_py())
                        count[row] = len(words)
                        for start, end, who in search(words, tables):
                            spans.extend((start, end))
                            owners.update(who)
                del tables
            for batch, hits, count in zip(held, found, counts):
                spans = [np.array(s, np.int32) for s, _ in hits]
                items = [sorted(owners) for _, owners in hits]
                digests = [hashlib.sha256(",".join(i).encode("utf-8")).hexdigest() for i in items]
                columns = {
                    "n_words": pa.array(count, pa.int64()),
                    "n_hit": pa.array([covered(s.reshape(-1, 2)) for s in spans], pa.int64()),
                    "items": pa.array(items, pa.list_(pa.string())),
                    "items_sha256": pa.array(digests, pa.string()),
                    "hit_spans": pa.array([s.tobytes() for s in spans], pa.binary()),
                }
                yield extended(batch, list(drop), columns)

    return docs.mapInArrow(run, schema_of(docs, list(drop), added))


def _compiled(block: list[tuple[str | None, str | None]], window: int) -> Tables:
    return compile_windows([(item, words_of(text)) for item, text in block], window)


def portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches together until they pass ``size`` bytes."""
    held, so_far = [], 0
    for batch in batches:
        held.append(batch)
        so_far += batch.nbytes
        if so_far > size:
            yield held
            held, so_far = [], 0
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Result of the query, one row per document."""
    found = find_leaks(take(docs, doc_id="doc_id", text="text"), benchmark, drop=("text",))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items_sha256",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, in which no window of the benchmark occurs."""
    named, back = keyed(docs, text="text")
    return back(find_leaks(named, benchmark, drop=("text",)).filter("n_hit = 0"))


SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, list_slice(w, i, i + least(10, len(w)) - 1) AS words
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
    SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows))
), hits AS (
    SELECT doc_id, item_id, i, size FROM places JOIN windows USING (size, words)
), marked AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""
