"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit set where more than half of a text's shingle hashes have it.
Fingerprints link where at most ``radius`` bits differ.  The bits are dealt to the
nonzero vectors of ``radius + 1`` bits; table ``v`` keeps the bits whose vector has an
odd product with ``v``.  The vectors of up to ``radius`` differing bits never span the
whole space, so some ``v`` is orthogonal to all of them: every pair within the radius
agrees in the kept bits of that table, and none is missed.

Only distinct fingerprints are dealt, 8 bytes each.  A bucket is linked to a star per
component (its smallest member), never to all pairs.  A bucket with very many members
is dealt anew by a second family of masks over the bits its table left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import extended, keyed, schema_of, slices, take
from samplelake.staging import scope, stage

BITS = 64
SEED = 42
RADIUS = 4
# Distinct fingerprints of a bucket above which it is dealt to a second family of masks.
HOT_BUCKET = 20_000
# One of so many fingerprints is counted to find hot buckets; it changes plans, not results.
HOT_SAMPLE = 16
# Odd, so that multiplication is one to one: it mixes fingerprints to vertex names.
MIX = 0x9E3779B97F4A7C15


def covering_masks(radius: int = RADIUS, bits: list[int] | None = None) -> list[int]:
    """Masks of which any two words differing in at most ``radius`` of ``bits`` agree on one."""
    bits = list(range(BITS)) if bits is None else bits
    vectors = 2 ** (radius + 1) - 1
    dealt = [(bit, place % vectors + 1) for place, bit in enumerate(bits)]
    masks = (sum(1 << bit for bit, m in dealt if (m & v).bit_count() % 2) for v in range(1, vectors + 1))
    return list(dict.fromkeys(masks))


def second_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Finer masks for a bucket of ``mask``: it, and a covering of the bits it leaves out."""
    left = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | m for m in covering_masks(radius, left)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_of(text: str | None, width: int) -> int:
    """Fingerprint of a whole text; one without words has zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    width = min(width, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):  # bounds the unpacked bits of very long texts
        part = hashes[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def vertex_names(fps: np.ndarray) -> np.ndarray:
    """Names of fingerprints in links: the same bits, mixed, so that their order is as good as random."""
    return (fps * np.uint64(MIX)).view(np.int64)


def fingerprints(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """Replace the text by ``fp``, its fingerprint as a signed long, and ``v``, its vertex name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = np.array([fingerprint_of(t.as_py(), width) for t in part.column(text)], np.uint64)
            columns = {"fp": pa.array(found.view(np.int64)), "v": pa.array(vertex_names(found))}
            yield extended(part, [text], columns)

    return docs.mapInArrow(run, schema_of(docs, [text], "fp long, v long"))


def _components(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(root place, member place) links of distinct sorted fingerprints: a star per component."""
    links: list[tuple[int, int]] = []
    rest = np.arange(1, len(values))
    for root in range(len(values)):
        if root and (not len(rest) or rest[0] != root):
            continue
        rest = rest[rest != root]
        open_, members = [root], []
        while open_ and len(rest):
            near = np.bitwise_count(values[rest] ^ values[open_.pop()]) <= radius
            found = rest[near]
            rest = rest[~near]
            members += found.tolist()
            open_ += found.tolist()
        links += [(root, m) for m in members]
    return links


def _bucket_links(values: np.ndarray, mask: int, radius: int, most: int) -> Iterator[np.ndarray]:
    """Stars of one bucket; one over ``most`` is cut by finer masks while enough bits are left.

    With few bits left a mask may add none; so few bits hold few fingerprints.
    """
    finer = second_masks(mask, radius) if len(values) > most else []
    if len(values) <= most or mask in finer:
        links = _components(values, radius)
        if links:
            yield values[np.array(links)]
        return
    for sub in finer:
        kept = values & np.uint64(sub)
        order = np.argsort(kept, kind="stable")
        edges = np.flatnonzero(np.diff(kept[order])) + 1
        for run in np.split(order, edges):
            if len(run) > 1:
                yield from _bucket_links(np.sort(values[run]), sub, radius, most)


def links(distinct: DataFrame, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Links ``a, b`` of distinct fingerprints ``fp`` that join all that are near, a < b by name.

    The result has the same connected components as all pairs within the radius.  The
    ends are vertex names.
    """
    first = covering_masks(radius)
    every = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(first)])
    dealt = distinct.select("fp", F.explode(every).alias("d")).select(
        "fp", F.col("d.m").alias("mask"), F.col("fp").bitwiseAND(F.col("d.m")).alias("key")
    )
    # A bucket is hot by its share of a fixed sample, so that all its members agree on it.
    sample = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(HOT_SAMPLE)) == 0)
    hot_keys = (
        sample.select("fp", F.explode(every).alias("d"))
        .groupBy(F.col("d.m").alias("mask"), F.col("fp").bitwiseAND(F.col("d.m")).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") * HOT_SAMPLE > hot_bucket)
        .select("mask", "key")
    )
    hot = stage(hot_keys, "hotbuckets")
    if hot.isEmpty():
        buckets = dealt
    else:
        finer = F.create_map(
            *[x for m in first for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in second_masks(m, radius)]))]
        )
        split = (
            dealt.join(hot, ["mask", "key"], "left_semi")
            .select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
            .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        )
        buckets = dealt.join(hot, ["mask", "key"], "left_anti").unionByName(split)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars(mask: int, values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for found in _bucket_links(np.unique(np.concatenate(values)), mask, radius, hot_bucket):
                mixed = np.sort(vertex_names(found), axis=1)
                for at in range(0, len(mixed), 10_000):
                    part = mixed[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["a", "b"])

        open_: tuple[int, int] | None = None
        held: list[np.ndarray] = []
        for batch in batches:
            mask, key, fp = (batch.column(n).to_numpy() for n in ("mask", "key", "fp"))
            if not len(fp):
                continue
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
            begins, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(fp)]
            # Most buckets inside a batch have one member; only the others and the outer two are looked at.
            for k, (x, y) in enumerate(zip(begins, ends)):
                if y - x == 1 and 0 < k < len(begins) - 1:
                    continue
                at = (int(mask[x]), int(key[x]))
                if at != open_:
                    if open_ and sum(map(len, held)) > 1:
                        yield from stars(open_[0] % (1 << 64), held)
                    open_, held = at, []
                held.append(fp[x:y].view(np.uint64))
        if open_ and sum(map(len, held)) > 1:
            yield from stars(open_[0] % (1 << 64), held)

    sorted_ = buckets.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return sorted_.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of the links ``a, b``; the root is the smallest name of its component.

    Each round hangs every vertex with a smaller neighbour below its smallest one and
    keeps the links between what the ends hang from.  Names are mixed, so a long chain
    shrinks by a fixed share each round.  Rounds are written tables; nothing is gathered.
    """
    with scope() as rounds:
        return rounds.keep(_rounds(edges), "roots")


def _rounds(edges: DataFrame) -> DataFrame:
    rest = stage(edges, "links")
    hung: list[DataFrame] = []
    while not rest.isEmpty():
        lower = stage(rest.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("up")), "lower")
        hung.append(lower)
        up = rest.join(lower.select(F.col("v").alias("a"), F.col("up").alias("up_a")), "a", "left").join(
            lower.select(F.col("v").alias("b"), F.col("up").alias("up_b")), "b"
        )
        x, y = F.coalesce("up_a", "a"), F.col("up_b")
        rest = stage(
            up.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).filter("a != b").distinct(), "links"
        )
    if not hung:
        return edges.sparkSession.createDataFrame([], "v long, root long")
    # From the last round back, so that each answer is already a root.
    roots = hung[-1].withColumnRenamed("up", "root")
    for lower in reversed(hung[:-1]):
        known = roots.select(F.col("v").alias("up"), F.col("root").alias("above"))
        here = lower.join(known, "up", "left").select("v", F.coalesce("above", "up").alias("root"))
        roots = stage(here.unionByName(roots).groupBy("v").agg(F.min("root").alias("root")), "roots")
    return roots


def near_groups(docs: DataFrame, width: int = 4, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``text`` to ``fp, component_id, group``, one row per row, with its ``doc_id`` and other columns.

    group names the component, also where it has no ids.
    component_id is the smallest doc_id whose fingerprint can be reached over links, null
    ids left out (null where all are).  Null and empty texts have fingerprint zero and
    link like any other; repeated rows give repeated rows; an empty table gives none.
    """
    marked = stage(fingerprints(docs, width), "fingerprints")
    with scope() as linking:
        distinct = stage(marked.groupBy("fp", "v").agg(F.min("doc_id").alias("least")), "distinct")
        roots = components(links(distinct.select("fp"), radius, hot_bucket))
        placed = distinct.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
        least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        # The hot side of these joins is the left one, which adaptive execution can split.
        by_fp = linking.keep(
            placed.join(least, "root").select("fp", "component_id", F.col("root").alias("group")), "components"
        )
    return marked.drop("v").join(by_fp, "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Result of the query: ``doc_id, fingerprint, component_id`` for every document."""
    found = near_groups(take(docs, doc_id="doc_id", text="text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, width: int = 4) -> DataFrame:
    """The documents, all columns, with one row of each group: the smallest id, of equal ids any one.

    Rows without an id go where their group has one with an id.  The choice is made on
    narrow rows, and one bit for each row of the written table says which rows stay: the
    bits are broadcast, so that no text is shuffled.
    """
    named, back = keyed(docs, doc_id="doc_id", text="text")
    placed = stage(named.withColumn("row", F.monotonically_increasing_id()), "rows")
    with scope() as choosing:
        found = near_groups(placed.select("row", "doc_id", "text"), width)
        # Summed per task before the shuffle, so a group of any size sends one row a task.
        first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
        row = F.col("first.row")
        bits = first.groupBy(F.bitmap_bucket_number(row).alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(row)).alias("bits")
        )
        kept = choosing.keep(bits, "kept")
    at = F.bitmap_bit_position("row")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    chosen = placed.withColumn("block", F.bitmap_bucket_number("row")).join(F.broadcast(kept), "block")
    return back(chosen.filter(F.getbit(byte, (at % 8).cast("int")) == 1))
