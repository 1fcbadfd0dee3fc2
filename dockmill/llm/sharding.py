"""Uniform sharding by a hypergeometric communication matrix.

A uniform random permutation of N rows can be dealt in two local steps
(Sanders 1998): the numbers of rows that each of P parts sends to each of S
shards follow a multivariate hypergeometric law given the shard sizes.  So the
driver draws that P x S matrix exactly, each part permutes its own rows and cuts
the permuted list by its matrix row, the rows are exchanged, and each shard
permutes what it received.  Shard sizes are exact: they differ by one at most.

Nothing here grows with the data but the rows themselves: the matrix has
``n_parts * n_shards`` numbers and the slot offsets ``n_shards * n_cells``, both
fixed by parameters.  Parts and cells come from hashes of the row's key, never
from Spark's partition ids, so that a task that runs again deals the same rows
to the same places.

Defined results: a null key hashes like any value; rows repeated in full are
dealt each on its own (which of two equal rows gets which slot is immaterial);
an empty table gives an empty result; input columns keep their names, and a
column named like an output (``shard``, ``slot``) is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.plans.shared import materialize

N_PARTS = 4096
N_CELLS = 256


def shard_sizes(total: int, n_shards: int) -> np.ndarray:
    """Sizes at most one apart that sum to ``total``."""
    sizes = np.full(n_shards, total // n_shards, dtype=np.int64)
    sizes[: total % n_shards] += 1
    return sizes


def communication_matrix(counts: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Draw how many rows each part sends to each shard.

    Row p sums to ``counts[p]`` and column s to the size of shard s.  Part by
    part, the row is a multivariate hypergeometric draw from the room left in
    the shards.  The marginals method draws counts only, so its cost and memory
    do not depend on the number of rows.
    """
    rng = np.random.default_rng(seed)
    room = shard_sizes(int(counts.sum()), n_shards)
    out = np.zeros((len(counts), n_shards), dtype=np.int64)
    for p, n in enumerate(counts):
        out[p] = draw = _multivariate_hypergeometric(rng, room, int(n))
        room = room - draw
    return out


def _multivariate_hypergeometric(rng: np.random.Generator, room: np.ndarray, n: int) -> np.ndarray:
    """numpy's own draw, and beyond its bound of 10^9 items one by halves."""
    total = int(room.sum())
    if total < 10**9:
        return rng.multivariate_hypergeometric(room, n, method="marginals")
    draw = np.zeros(len(room), dtype=np.int64)
    for s, r in enumerate(room):
        if n == 0:
            break
        total -= int(r)
        draw[s] = _hypergeometric(rng, int(r), total, n)
        n -= int(draw[s])
    return draw


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    if bad == 0:
        return n
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    # Inversion: ratios of neighbouring probabilities from the mode outwards.  What lies beyond
    # ten standard deviations and 60 is less than the last bit of the uniform number.
    share = good / (good + bad)
    spread = (n * share * (1 - share) * (good + bad - n) / (good + bad - 1)) ** 0.5
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    width = int(10 * spread) + 60
    first, last = max(low, mode - width), min(high, mode + width)
    k = np.arange(first, last, dtype=np.float64)
    ratio = (good - k) / (k + 1) * ((n - k) / (bad - n + k + 1))
    down, up = np.cumprod(1 / ratio[: mode - first][::-1])[::-1], np.cumprod(ratio[mode - first :])
    below = np.cumsum(np.concatenate([down, [1.0], up]))
    return first + int(np.searchsorted(below, rng.random() * below[-1], side="right"))


def assign_shards(df: DataFrame, key: list[Column], n_shards: int, *, seed: int = 20, n_parts: int = N_PARTS, n_cells: int = N_CELLS) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard).

    ``key`` identifies a row; rows with equal keys share a part, so it should
    be (nearly) unique.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")

    def mixed(k: int) -> Column:
        return F.xxhash64(*key, F.lit(seed * 7919 + k))

    parted = df.withColumn("__part", F.pmod(mixed(0), F.lit(n_parts)).cast("int"))
    counts = np.zeros(n_parts, dtype=np.int64)
    for r in parted.groupBy("__part").count().collect():  # n_parts rows at most
        counts[r[0]] = r[1]
    cuts = np.cumsum(communication_matrix(counts, n_shards, seed), axis=1)
    bounds = spark.createDataFrame([(p, row.tolist()) for p, row in enumerate(cuts)], "__part int, __cuts array<bigint>")

    local = Window.partitionBy("__part").orderBy(mixed(1), *key)
    dealt = (
        parted.withColumn("__at", F.row_number().over(local) - 1)
        .join(F.broadcast(bounds), "__part")  # n_parts * n_shards numbers
        .withColumn("shard", F.size(F.filter("__cuts", lambda c: c <= F.col("__at"))))
        .withColumn("__cell", F.pmod(mixed(2), F.lit(n_cells)).cast("int"))
        .drop("__part", "__cuts", "__at")
    )
    dealt = materialize(dealt, "dealt")

    before = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "__cell").count().select("shard", "__cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("shard", "__cell").orderBy(mixed(3), *key)
    return (
        dealt.withColumn("slot", F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(offsets), ["shard", "__cell"])  # n_shards * n_cells rows
        .withColumn("slot", F.col("slot") + F.col("__before"))
        .drop("__cell", "__before")
    )


def write_shards(df: DataFrame, key: list[Column], n_shards: int, path: str, **options: int) -> None:
    """Write ``df`` as one folder a shard, its rows in the order of their slots."""
    placed = assign_shards(df, key, n_shards, **options)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards by the law ``rows``; a null text counts 8 bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    placed = assign_shards(docs, [F.col("doc_id"), F.col("text_crc32")], 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
