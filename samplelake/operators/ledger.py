"""What is done and what is left: resume by joins against a ledger table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEDGER_KEYS = ["job_id", "shard", "sample_idx"]


def pending_work(todo: DataFrame, ledger: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Rows the ledger does not hold."""
    keys = on or LEDGER_KEYS
    return todo.join(ledger.select(*keys), keys, "left_anti")


def produced_only(todo: DataFrame, produced: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose output exists."""
    return todo.join(produced.select(*on), on, "left_semi")


def needed_shards(pending: DataFrame) -> DataFrame:
    """Shards with pending rows."""
    return pending.select("shard").distinct()


def rows_per_shard(pending: DataFrame) -> DataFrame:
    """Pending samples of each shard, counted without gathering them."""
    return pending.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("sample_idx").alias("first_idx"),
        F.max("sample_idx").alias("last_idx"),
    )


def append_ledger(ledger: DataFrame, done: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Ledger with the finished rows added once each."""
    keys = on or LEDGER_KEYS
    return ledger.select(*keys).unionByName(done.select(*keys)).dropDuplicates(keys)


def reconcile_keys(processed: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """Keys on one side only, with the side; empty where both sets are equal.

    One aggregation over both sides, so a key repeated many times is combined
    before the shuffle.
    """
    sides = processed.select(*on, F.lit(True).alias("p"), F.lit(False).alias("e")).unionByName(
        expected.select(*on, F.lit(False).alias("p"), F.lit(True).alias("e"))
    )
    return (
        sides.groupBy(*on)
        .agg(F.bool_or("p").alias("p"), F.bool_or("e").alias("e"))
        .filter(F.col("p") != F.col("e"))
        .select(*on, F.when(F.col("p"), F.lit("unexpected")).otherwise(F.lit("missing")).alias("side"))
    )


def join_manifest(samples: DataFrame, manifest: DataFrame) -> DataFrame:
    """Shard samples with their manifest rows, on shard and place in the shard."""
    return samples.join(manifest, ["shard", "sample_idx"])
