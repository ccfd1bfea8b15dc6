"""Incremental scans: each object is validated once, whenever it arrives and whatever its date."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplelake.operators.ledger import pending_work
from samplelake.operators.listing import filter_images
from samplelake.operators.numbering import number_rows
from samplelake.operators.scanning import validate_bytes
from samplelake.plans.jobs import WAVE_FILES, append_to_ledger, read_ledger, waves
from samplelake.sources.objects import fetch_content, list_objects, spread_by_bytes

JOB = "scan"


def incremental_scan(
    spark: SparkSession, root: str, out: str, checkpoint: str, files_per_batch: int = WAVE_FILES
) -> DataFrame:
    """Scan metadata of every object seen so far; only new objects are read.

    New is what the listing has and the ledger at ``checkpoint`` has not.  Output is
    written before its ledger rows, and counts once they are there.
    """
    base = out.rstrip("/")
    todo = pending_work(filter_images(list_objects(spark, root)), read_ledger(spark, checkpoint, JOB), ["key"])
    for part in waves(number_rows(todo, ["key"]), files_per_batch):
        run = uuid.uuid4().hex
        content = fetch_content(spread_by_bytes(part, "size_bytes", ["key"]))
        validate_bytes(content).write.parquet(f"{base}/run={run}")
        append_to_ledger(spark.read.parquet(f"{base}/run={run}").select("key"), checkpoint, JOB, run)
    runs = read_ledger(spark, checkpoint, JOB).select(F.col("run_id").alias("run")).distinct()
    nothing = validate_bytes(spark.createDataFrame([], "key string, size_bytes long, content binary"))
    if runs.isEmpty():
        return nothing
    return spark.read.parquet(base).join(runs, "run", "left_semi").select(*nothing.columns)
