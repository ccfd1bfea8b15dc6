"""The registry of scans: append-only rows, newest last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from samplelake.sources.tables import NO_PATH

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("source_bucket", T.StringType()),
        T.StructField("source_prefix", T.StringType()),
        T.StructField("metadata_key", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("total", T.LongType()),
        T.StructField("corrupted", T.LongType()),
    ]
)
MAX_ENTRIES = 50


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The recorded scans; none where the table does not exist."""
    try:
        return spark.read.schema(REGISTRY_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != NO_PATH:
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def append_scan(entries: DataFrame, path: str) -> None:
    """Add scans as new files: writers never read or replace each other's rows."""
    entries.select(*REGISTRY_SCHEMA.fieldNames()).write.mode("append").parquet(path)


def last_scans(registry: DataFrame, n: int = MAX_ENTRIES, tie: str | None = None) -> DataFrame:
    """The newest ``n`` scans, newest first."""
    order = [F.desc("at"), F.desc(tie or "metadata_key")]
    return registry.orderBy(*order).limit(n)
