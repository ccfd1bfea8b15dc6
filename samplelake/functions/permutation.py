"""Keyed permutations of the numbers below n, as expressions: an order without a sort.

A Feistel network over pairs ``x, y`` of numbers below ``a`` and ``b``, where ``a * b``
is just above n: each half round adds a keyed polynomial of one number to the other.
That is one to one whatever the polynomial does.  The fewer than sqrt(n) + 1 pairs that
stand for numbers from n up are left by applying the network again (cycle walking); how
often that can be needed is worked out exactly for the key, from just those pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from samplelake.functions.pixels import let

# The largest prime below 2^31, so that products of two remainders fit a long.
PRIME = 2**31 - 1
HALF_ROUNDS = 8

Keys = list[tuple[int, int, int]]


def network_keys(seed: int, epoch: int) -> Keys:
    """Three coefficients of each half round's polynomial, the leading one not zero."""
    digests = [hashlib.sha256(f"{seed}:{epoch}:{i}".encode()).digest() for i in range(HALF_ROUNDS)]
    parts = [[int.from_bytes(d[k : k + 8], "big") for k in (0, 8, 16)] for d in digests]
    return [(1 + p % (PRIME - 1), q % PRIME, r % PRIME) for p, q, r in parts]


def sides(n: int) -> tuple[int, int]:
    """The two moduli: their product is n or less than sqrt(n) + 1 above it."""
    if not 0 < n <= (PRIME - 1) ** 2:
        raise ValueError("a permutation needs at least one number, and fewer than 2^62")
    a = math.isqrt(n - 1) + 1
    return a, -(-n // a)


def forward(values: np.ndarray, n: int, keys: Keys) -> np.ndarray:
    """The network once, over longs below ``a * b``."""
    m, other = sides(n)
    x, y = values // other, values % other
    for p, q, r in keys:
        x, y = y, (x + ((p * y + q) % PRIME * y + r) % PRIME) % m
        m, other = other, m
    return x * other + y


def backward(value: int, n: int, keys: Keys) -> int:
    """The number that the network takes to this one."""
    m, other = sides(n)
    x, y = divmod(value, other)
    # After an even number of half rounds the moduli stand as at the start.
    for p, q, r in reversed(keys):
        m, other = other, m
        x, y = (y - ((p * x + q) % PRIME * x + r) % PRIME) % m, x
    return x * other + y


def passes(n: int, keys: Keys) -> int:
    """How often the network must be applied so that every number below n is led back below n."""
    a, b = sides(n)
    left, count = np.arange(n, a * b, dtype=np.int64), 1
    while len(left):
        left, count = forward(left, n, keys), count + 1
        left = left[left >= n]
    return count


def permuted(index: Column, n: int, seed: int, epoch: int = 0) -> Column:
    """The place of each index below ``n``: every place below ``n`` once."""
    keys = network_keys(seed, epoch)
    a, b = sides(n)
    parts = F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for v, c in zip(k, "pqr")]) for k in keys])

    def half(s: Column, k: Column) -> Column:
        moved = (((k["p"] * s["y"] + k["q"]) % PRIME) * s["y"] + k["r"]) % PRIME
        return F.struct(s["y"].alias("x"), ((s["x"] + moved) % s["m"]).alias("y"), s["o"].alias("m"), s["m"].alias("o"))

    def once(value: Column) -> Column:
        start = F.struct(
            F.call_function("div", value, F.lit(b).cast("long")).alias("x"),
            (value % b).alias("y"),
            F.lit(a).cast("long").alias("m"),
            F.lit(b).cast("long").alias("o"),
        )
        return F.aggregate(parts, start, half, lambda s: s["x"] * s["o"] + s["y"])

    out = once(index.cast("long"))
    for _ in range(passes(n, keys) - 1):
        out = let(out, lambda v: F.when(v < n, v).otherwise(once(v)))
    return out


def index_at(place: int, n: int, seed: int, epoch: int = 0) -> int:
    """The index that :func:`permuted` puts at a place."""
    keys = network_keys(seed, epoch)
    value = backward(place, n, keys)
    while value >= n:
        value = backward(value, n, keys)
    return value


def permuted_sql(source: str, seed: int, epoch: int) -> str:
    """CTEs for DuckDB, to follow ``WITH RECURSIVE``: ``permuted(idx, pos)`` of all rows of ``source(idx)``."""

    def half(inner: str, p: int, q: int, r: int) -> str:
        moved = f"((({p} * y + {q}) % {PRIME}) * y + {r}) % {PRIME}"
        return f"(SELECT idx, step, y AS x, (x + {moved}) % m AS y, o AS m, m AS o FROM {inner})"

    net = "(SELECT idx, step, v // b AS x, v % b AS y, a AS m, b AS o FROM walk, sides WHERE step = 0 OR v >= n)"
    for key in network_keys(seed, epoch):
        net = half(net, *key)
    return f"""sides AS (
  SELECT n, a, (n + a - 1) // a AS b FROM (
    SELECT n, CASE WHEN r * r >= n THEN r ELSE r + 1 END AS a FROM (
      SELECT count(*) AS n, floor(sqrt(count(*)))::BIGINT AS r FROM {source}))),
walk(idx, step, v) AS (
  SELECT idx, 0, idx::BIGINT FROM {source} UNION ALL SELECT idx, step + 1, x * o + y FROM {net}),
permuted AS (SELECT idx, v AS pos FROM walk, sides WHERE step > 0 AND v < n)"""
