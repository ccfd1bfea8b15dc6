"""Shards of nearly equal bytes: a minimax partition of ordered groups of equal texts.

A group of equal texts is never cut.  Groups are ordered by their digest, and their
sizes summed along that order.  The smallest capacity that fits all of them into the
shards, one shard after another, is searched; each check walks greedily, one lookup of
the next cut per shard, for many capacities at once.  A group over its fair share of
all bytes has a shard of its own, so that one hot group does not set the others' size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplelake.llm.common import take
from samplelake.operators.numbering import number_rows
from samplelake.staging import stage

SHARDS = 8
# Capacities checked at a time: each round cuts the range of the search by this factor.
TRIED = 32
LAW = "bytes"


def summed(groups: DataFrame) -> DataFrame:
    """``key, upto`` of groups ``key, bytes``: bytes of all groups up to this one, by key."""
    placed = stage(
        groups.repartitionByRange("key").withColumn("part", F.spark_partition_id()).select("part", "key", "bytes"),
        "groups",
    )
    # One row per partition stands in the window without a key.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.sum("bytes").alias("bytes"))
    offsets = offsets.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"))
    here = F.sum("bytes").over(Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    return stage(
        placed.withColumn("here", here)
        .join(F.broadcast(offsets), "part")
        .select("key", (F.col("offset") + F.col("here")).alias("upto")),
        "summed",
    )


def greedy_cuts(upto: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """Where each capacity's shards end, in bytes from the start; one pass over the sums per shard."""
    ends: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        reach = [(e[-1] if e else 0) + c for e, c in zip(ends, capacities)]
        within = upto.filter(F.col("upto").between(min(reach) - max(capacities), max(reach)))
        row = within.agg(*[F.max(F.when(F.col("upto") <= r, F.col("upto"))).alias(f"c{i}") for i, r in enumerate(reach)])
        for e, end in zip(ends, row.first()):
            e.append(max(end or 0, e[-1] if e else 0))
    return ends


def smallest_capacity(upto: DataFrame, total: int, largest: int, shards: int) -> list[int]:
    """Ends of the shards under the smallest capacity that fits everything."""
    fair = -(-total // shards)
    low, high = max(fair, largest), fair + largest  # the upper one always fits
    best = greedy_cuts(upto, [high], shards)[0]
    while low < high:
        step = max(1, (high - low) // TRIED)
        tried = list(range(low, high, step))[: TRIED + 1]
        ends = greedy_cuts(upto, tried, shards)
        fits = next((i for i, e in enumerate(ends) if e[-1] == total), None)
        if fits is None:
            low = tried[-1] + 1
        else:
            high, best = tried[fits], ends[fits]
            low = tried[fits - 1] + 1 if fits else high
    return best


def _sized(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        # Null texts are a group of their own, before all others.
        F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("")).alias("key"),
    )


def shard_of(rows: DataFrame, shards: int = SHARDS) -> Column:
    """The shard of each row ``size, key``; needs rows that are cheap to read again."""
    groups = stage(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "sizes")
    total = groups.agg(F.sum("bytes")).first()[0]
    if not total:
        return F.lit(0)
    # No more groups than shards can be over their fair share of what is left.
    alone: list[str] = []
    for row in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        left = shards - len(alone)
        if left == 1 or row["bytes"] * left <= total:
            break
        alone.append(row["key"])
        total -= row["bytes"]
    rest = groups.filter(~F.col("key").isin(alone)) if alone else groups
    cuts: list[str] = []
    if total:
        upto = summed(rest)
        largest = rest.agg(F.max("bytes")).first()[0]
        ends = smallest_capacity(upto, total, largest, shards - len(alone))
        found = upto.filter(F.col("upto").isin(ends[:-1])).select("key", "upto").collect()
        keys = {r["upto"]: r["key"] for r in found}
        # The sums grow with every group, so each end is one group; ends after the last stay empty.
        cuts = [keys[e] for e in ends[:-1] if e in keys and e < total]
    place = F.lit(len(alone))
    for cut in cuts:
        place = place + F.when(F.col("key") > cut, 1).otherwise(0)
    for i, key in enumerate(alone):
        place = F.when(F.col("key") == key, i).otherwise(place)
    return place


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Result of the query: every document with its shard and its place in it.

    A null text has one byte and checksum 0; null texts are one group, empty ones another.
    Repeated rows are in one group and have places of their own.  An empty table gives no
    row.  Places follow the order of group and doc_id.
    """
    rows = stage(_sized(take(docs, doc_id="doc_id", text="text")), "sized")
    placed = number_rows(rows.withColumn("shard", shard_of(rows, shards).cast("int")), ["shard", "key", "doc_id"], "at")
    placed = stage(placed.drop("key"), "placed")
    first = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("at").alias("first")).collect()}
    start = F.lit(0).cast("long")
    for shard, at in first.items():
        start = F.when(F.col("shard") == shard, F.lit(at).cast("long")).otherwise(start)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("at") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
