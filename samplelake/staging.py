"""Tables written to the shared folder, where lineage is cut.

The folder comes from ``spark.checkpoint.dir``.  A staged table outlives any lost
executor, is read back with column pruning, and has a real size on disk, so
Catalyst can decide joins against it from facts.  One folder per application;
:func:`drop_staged` removes it at the end.  What is staged inside :func:`scope` goes
when the scope ends, but for the tables it was told to keep.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


class Scope:
    """Paths staged since the scope began."""

    def __init__(self, outer: Scope | None) -> None:
        self.outer = outer
        self.paths: list[tuple[SparkSession, str]] = []

    def keep(self, df: DataFrame, label: str = "table") -> DataFrame:
        """Stage ``df`` outside the scope, so that it outlives it."""
        token = _innermost.set(self.outer)
        try:
            return stage(df, label)
        finally:
            _innermost.reset(token)


_innermost: ContextVar[Scope | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read and write, without a trailing slash."""
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="samplelake-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one staged table or folder of this application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/samplelake-{app}/{label}-{uuid.uuid4().hex[:12]}"


def _delete(spark: SparkSession, path: str) -> None:
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    named.getFileSystem(spark._jsc.hadoopConfiguration()).delete(named, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; DataFrames that read it end with it."""
    _delete(spark, staging_path(spark, "x").rsplit("/", 1)[0])


@contextmanager
def scope() -> Iterator[Scope]:
    """Tables staged inside are deleted at the end; what is to outlive it passes :meth:`Scope.keep`."""
    inner = Scope(_innermost.get())
    token = _innermost.set(inner)
    try:
        yield inner
    finally:
        _innermost.reset(token)
        for spark, path in inner.paths:
            _delete(spark, path)


def stage(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    open_ = _innermost.get()
    if open_:
        open_.paths.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
