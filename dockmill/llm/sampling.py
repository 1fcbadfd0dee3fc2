"""A bounded, repeatable sample of a table: the rows with the smallest hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 12


def with_hash(rows: DataFrame, key: Column) -> DataFrame:
    """``rows`` with ``__h``, a non-negative hash of ``key``."""
    return rows.withColumn("__h", F.shiftrightunsigned(F.xxhash64(key), 1))


def bound(rows: DataFrame, at_most: int) -> int:
    """A hash such that it and smaller ones have ``at_most`` rows or more (or all), but not over twice as many.

    Rows are counted by the hash's first bits, then, where one range has too
    many, inside that range: 4,096 counts reach the driver each time, whatever
    the number of rows.  Rows with equal keys stay together and may be more.
    """
    low, high, below, shift = 0, 2**63 - 1, 0, 63 - _BITS
    while True:
        counts = rows.where(F.col("__h").between(low, high)).groupBy(F.shiftright("__h", shift).alias("b")).count().collect()
        upto = below
        for b, n in sorted((r[0], r[1]) for r in counts):
            upto += n
            if upto >= at_most:
                break
        else:
            return high
        if upto <= 2 * at_most or shift == 0:
            return ((b + 1) << shift) - 1
        low, high, below, shift = b << shift, ((b + 1) << shift) - 1, upto - n, max(0, shift - _BITS)


def smallest(rows: DataFrame, key: Column, columns: list[str], at_most: int) -> list[tuple]:
    """``columns`` of the ``at_most`` rows with the smallest hashes of ``key``."""
    hashed = with_hash(rows, key)
    near = hashed.where(F.col("__h") <= bound(hashed, at_most))
    return [tuple(r) for r in near.orderBy("__h", *columns).select(*columns).limit(at_most).collect()]
