"""Small value functions: hashes, class ids on the wire, stamps, uniform draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two 32-bit mixing constants and the range they work in.
MIX_CONSTANT = 0x45D9F3B
MASK32 = 0xFFFFFFFF
RANGE32 = float(1 << 32)


def source_hash(source: Column) -> Column:
    """First 12 hex digits of the SHA-256 of a source string."""
    return F.substring(F.sha2(source, 256), 1, 12)


def class_to_bytes(class_id: Column) -> Column:
    """Four little-endian bytes of a class id."""
    big = F.right(F.lpad(F.hex(class_id.cast("long")), 16, "0"), F.lit(8))
    pairs = [F.substring(big, p, 2) for p in (7, 5, 3, 1)]
    return F.unhex(F.concat(*pairs))


def class_from_bytes(raw: Column) -> Column:
    pairs = [F.substring(F.hex(raw), p, 2) for p in (7, 5, 3, 1)]
    unsigned = F.conv(F.concat(*pairs), 16, 10).cast("long")
    signed = F.when(unsigned > 0x7FFFFFFF, unsigned - (1 << 32)).otherwise(unsigned)
    return signed.cast("int")


def iso_stamp(ts: Column) -> Column:
    """ISO-8601 UTC stamp with ``Z``; whole seconds carry no fraction."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), F.lit("Z")
    )


def draw_base(seed: int, step: str, key: Column) -> Column:
    """32-bit integer that depends only on the seed, the step and the row's key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(step), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix32(value: Column) -> Column:
    """Scramble a 32-bit value held in a long; the products stay below 2**63."""
    for _ in range(2):
        value = value.bitwiseXOR(F.shiftright(value, 16))
        value = (value * F.lit(MIX_CONSTANT)).bitwiseAND(F.lit(MASK32))
    return value.bitwiseXOR(F.shiftright(value, 16))


def uniform(base: Column, index: Column | int) -> Column:
    """Uniform draw in [0, 1) number ``index`` of a row."""
    idx = index if isinstance(index, Column) else F.lit(index)
    return mix32((base + idx.cast("long") * F.lit(0x9E3779B1)).bitwiseAND(F.lit(MASK32))) / F.lit(RANGE32)
