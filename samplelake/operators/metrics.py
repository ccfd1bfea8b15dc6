"""Gauges, throughput and phase timings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAUGES = ["gpu_util_pct", "mem_used_mb", "mem_total_mb", "torch_allocated_mb"]


def gauge_summary(gauges: DataFrame) -> DataFrame:
    """Mean and maximum of every gauge."""
    return gauges.agg(
        *[f(c).alias(f"{n}_{c}") for c in GAUGES for n, f in (("mean", F.avg), ("max", F.max))]
    )


def throughput(steps: DataFrame) -> DataFrame:
    """Images per second and mean step time, 0 where nothing ran.

    ``steps`` has ``images, step_seconds, ts``.
    """
    span = F.coalesce(
        (F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp"))))
        / F.lit(1e6),
        F.lit(0.0),
    )
    totals = steps.agg(
        F.coalesce(F.sum("images"), F.lit(0)).alias("total_images"),
        F.count(F.lit(1)).alias("steps"),
        span.alias("elapsed_seconds"),
        F.coalesce(F.sum("step_seconds"), F.lit(0.0)).alias("_step_seconds"),
    )
    return totals.select(
        "total_images",
        "steps",
        "elapsed_seconds",
        F.when(F.col("elapsed_seconds") > 0, F.col("total_images") / F.col("elapsed_seconds"))
        .otherwise(F.lit(0.0))
        .alias("images_per_sec"),
        F.when(F.col("steps") > 0, F.col("_step_seconds") / F.col("steps") * 1000)
        .otherwise(F.lit(0.0))
        .alias("step_time_ms"),
    )


def phase_timings(runs: DataFrame) -> DataFrame:
    """Seconds spent in each phase."""
    return runs.groupBy("phase").agg(F.sum("seconds").alias("seconds"), F.count(F.lit(1)).alias("runs"))


def timing_line(phases: DataFrame) -> DataFrame:
    """One text per phase, as shown after a run."""
    return phases.select(F.format_string("%s %.1fs", "phase", "seconds").alias("line"))
