"""Shards of a tokenised corpus, and sums over shards of what each of them has counted.

A task cuts its texts into shards of about ``SHARD`` positions.  A shard is one
row with its words' local numbers, position by position, and a row for each
distinct word.  Words get their numbers in the whole corpus by a join of these
rows, so no vocabulary is ever broadcast.

Counts of n-grams are summed in parts: a shard deals the keys it has by a hash,
as columns of numbers, squeezed; a part adds up what it got from all shards, and
answers each of them in the order that it asked in.  Shards are bounded by
``SHARD``, parts by the number that is chosen for them, so neither a frequent word
nor a long document makes a large group.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.plans.shared import materialize

SHARD = 1 << 20
PART = 1 << 21  # keys that a part gets at most, on average
SEGMENT = 1 << 20  # bytes of a text that are split at once


class Numbers(dict):
    """Numbers words as they come."""

    def __init__(self, fixed: dict[bytes, int], count: itertools.count):
        super().__init__(fixed)
        self._count = count

    def __missing__(self, word: bytes) -> int:
        n = self[word] = next(self._count)
        return n


def segments(text: bytes) -> Iterator[bytes]:
    """``text``, cut at blanks into pieces of about ``SEGMENT`` bytes."""
    at = 0
    while len(text) - at > SEGMENT and (cut := text.find(b" ", at + SEGMENT)) >= 0:
        yield text[at:cut]
        at = cut
    yield text[at:]


def dense_ids(rows: DataFrame, name: str, column: str = "id", start: int = 1) -> DataFrame:
    """``rows``, written to the shared folder, with numbers without gaps from ``start`` in no particular order."""
    placed = materialize(rows.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), name)
    counts = {p: (least, n) for p, least, n in placed.groupBy("__part").agg(F.min("__at"), F.count("*")).collect()}  # a row a task
    shift, at = [], start
    for p, (least, n) in sorted(counts.items()):
        shift.append((p, at - least))
        at += n
    first = placed.sparkSession.createDataFrame(shift, "__part int, __shift long")
    return placed.join(F.broadcast(first), "__part").withColumn(column, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


def deal(columns: list[np.ndarray], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(the order in which keys are sent, where each part begins in it)."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    part = (h % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)  # short numbers are sorted by radix
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def width(largest: int) -> np.dtype:
    """The numbers' form in an exchange."""
    return np.dtype(np.uint32 if largest < 1 << 32 else np.uint64)


def packed(n: np.ndarray) -> bytes:
    """Counts as a byte each, squeezed; those from 255 on follow in full."""
    return zstandard.compress(np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype(np.int64).tobytes(), 1)


def unpacked(blob: bytes, size: int) -> np.ndarray:
    """``size`` counts."""
    blob = zstandard.decompress(blob)
    n = np.frombuffer(blob, dtype=np.uint8, count=size).astype(np.int64)
    n[n == 255] = np.frombuffer(blob, dtype=np.int64, offset=size)
    return n


def squeezed(x: np.ndarray) -> bytes:
    """An array in less space than the exchange's own compression takes: all first bytes of its numbers, all second ones and so on."""
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1)


def expanded(blob: bytes, form: type | np.dtype) -> np.ndarray:
    form = np.dtype(form)
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(form.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(form).reshape(-1)


def steps(x: np.ndarray) -> np.ndarray:
    """Each number's distance from the one before, in the same form (it wraps around); ``np.cumsum`` in that form undoes it."""
    out = x.copy()
    out[1:] -= x[:-1]
    return out


def asked(shard: int, columns: list[np.ndarray], n: np.ndarray, parts: int, form: np.dtype) -> list[tuple]:
    """Rows (part, shard, keys, n) that send a shard's keys and counts to their parts; keys are the columns' steps one after the other."""
    order, begin = deal(columns, parts)
    keys, n = [c[order].astype(form) for c in columns], n[order]
    full = np.flatnonzero(np.diff(begin))
    return [(int(p), shard, squeezed(np.concatenate([steps(c[begin[p] : begin[p + 1]]) for c in keys])), packed(n[begin[p] : begin[p + 1]])) for p in full]


ASKED = "part int, shard long, keys binary, n binary"
ASKED_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def added(rows: pa.Table, n_columns: int, form: np.dtype) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys by column, their sums, for each key as sent its place among them, where each row's keys begin)."""
    blobs = [np.cumsum(expanded(b, form).reshape(n_columns, -1), axis=1, dtype=form) for b in rows.column("keys").to_pylist()]
    begin = np.concatenate([[0], np.cumsum([b.shape[1] for b in blobs])]).astype(np.int64)
    columns = [np.concatenate([b[j] for b in blobs]) for j in range(n_columns)]
    n = np.concatenate([unpacked(x, b.shape[1]) for x, b in zip(rows.column("n").to_pylist(), blobs, strict=True)])
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]) if len(n) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    place = np.empty(len(n), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return [c[first] for c in columns], np.add.reduceat(n[order], first) if len(first) else n, place, begin


def by_shard(left: DataFrame, right: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``f`` on the rows of each shard in both tables."""
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # both may come from one table
    return left.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(f, schema)
