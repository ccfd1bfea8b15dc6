"""Live throughput: finished samples counted by event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def progress_windows(events: DataFrame, every: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """``window_start, n, total`` of ``ts, value`` events; works on streams and tables."""
    counted = (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", every))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    )
    return counted.select(F.col("window.start").alias("window_start"), "n", "total")


def drain_windows(progress: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run the counts over all that has arrived and give the latest state of every window.

    Each micro-batch appends the windows it changed under its own number, so windows
    still inside the watermark are reported too, and a repeated batch replaces itself.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run = (
        progress.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    run.awaitTermination()
    saved = progress.sparkSession.read.parquet(out)
    state = F.max_by(F.struct("n", "total"), "batch").alias("state")
    return saved.groupBy("window_start").agg(state).select("window_start", "state.*")
