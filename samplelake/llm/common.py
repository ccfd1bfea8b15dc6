"""Helpers the operators share: columns by place, batches in bounded slices, folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS = 512
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def take(df: DataFrame, **wanted: str) -> DataFrame:
    """Select ``new=old`` columns by exact name.

    Extra columns, also ones whose names clash with a wanted or a made column (in any
    case of letters), are left behind; where a name is there twice, its first place counts.
    """
    places = [f"c{i}" for i in range(len(df.columns))]
    by_place = df.toDF(*places)
    return by_place.select(*[by_place[places[df.columns.index(old)]].alias(new) for new, old in wanted.items()])


def keyed(df: DataFrame, **wanted: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows under private names beside the wanted columns, and the way back to their own names."""
    names, places = df.columns, [f"_c{i}" for i in range(len(df.columns))]
    by_place = df.toDF(*places)
    named = by_place.select("*", *[F.col(places[names.index(old)]).alias(new) for new, old in wanted.items()])
    return named, lambda out: out.select(*places).toDF(*names)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold nothing is learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches a few at a time, so that Python objects stay few."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def extended(batch: pa.RecordBatch, drop: list[str], columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without ``drop`` and with new columns at its end."""
    kept = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *columns.values()], [*kept, *columns])


def schema_of(df: DataFrame, drop: list[str], added: str) -> str:
    """The DDL of ``df`` without ``drop`` and with ``added`` at its end."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in drop]
    return ", ".join([*kept, added])


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    digits = "'0123456789ABCDEF'"
    nibble = f"(instr({digits}, substr(hex(encode({text})), CAST(k // 4 + 1 AS INT), 1)) - 1)"
    # Of each byte the lower digit, the second one, is mixed in first, and the other four bits later.
    nibble = nibble.replace("k // 4 + 1", "k // 4 + CASE WHEN k % 8 = 0 THEN 2 ELSE 0 END")
    mixed = f"xor(c, CASE WHEN k % 4 = 0 THEN {nibble} ELSE 0 END)"
    step = f"xor({mixed} >> 1, 3988292384 * ({mixed} & 1))"
    return f"xor(list_reduce(range(0, 8 * strlen({text})), lambda c, k: {step}, 4294967295), 4294967295)"
