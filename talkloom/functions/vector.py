"""Vectors and perceptual hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine_distance(a: Column, b: Column, b_norm: Column | None = None) -> Column:
    """1 - cosine. With a constant b, give its norm to compute it once."""
    return 1 - dot(a, b) / (norm(a) * (norm(b) if b_norm is None else b_norm))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def sign_hash(vector: Column, bits: int = 64) -> Column:
    """Bit i is set where component i is positive; of 64 bits the last is the sign. Null for a vector without components."""
    one = F.lit(1).cast("long")
    weighed = F.transform(F.slice(vector, 1, bits), lambda x, i: F.when(x > 0, F.call_function("shiftleft", one, i)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(vector) > 0, F.aggregate(weighed, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)))


def difference_hash(grey: Column) -> Column:
    """Perceptual hash of a picture of eight rows of nine grey values, row by row: bit i is set where a value's right neighbour is
    brighter. Null where there are fewer values."""
    left = lambda i: (9 * F.floor(i / 8) + i % 8).cast("int")
    steps = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.get(grey, left(i) + 1) - F.get(grey, left(i)))
    return F.when(F.size(grey) >= 72, sign_hash(steps))
