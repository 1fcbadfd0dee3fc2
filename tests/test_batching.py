"""Sequential and even batches against serial loops, in groups of all sizes."""

import heapq
import random

import pytest

from dockmill.operators import batching
from dockmill.plans.ordering import running
from pyspark.sql import functions as F


def serial_sequential(words, total, limit):
    number, filled, out = 1, 0, []
    for w in words:
        if sum(words) > total and filled and filled + w > limit:
            number, filled = number + 1, 0
        filled += w
        out.append(number)
    return out


def serial_even(words, limit):
    heap, out = [(0, b) for b in range(max(1, -(-sum(words) // limit)))], [0] * len(words)
    for i in sorted(range(len(words)), key=lambda i: (-words[i], i)):
        size, b = heapq.heappop(heap)
        out[i] = b
        heapq.heappush(heap, (size + words[i], b))
    return out


def groups(seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.randrange(0, 60), lambda: rng.choice([0, 0, 0, 120, 5]), lambda: 7, lambda: rng.randrange(90, 200), lambda: rng.randrange(3), lambda: 0]
    return {f"g{i}": [f() for _ in range(rng.choice([1, 2, 9, 150]))] for i, f in enumerate(kinds)} | {None: [50, 60, 1], "all": [rng.choice([1, 2, 3, 100, 0]) for _ in range(700)]}


def frame(spark, by):
    return spark.createDataFrame([(g, i, w) for g, ws in by.items() for i, w in enumerate(ws)], "g string, o int, w long").repartition(4)


@pytest.mark.parametrize("total,limit", [(0, 100), (300, 100), (0, 1), (10**9, 5)])
def test_sequential(spark, total, limit):
    by = groups(1)
    got = {(r.g, r.o): r.batch for r in batching.sequential_batches(frame(spark, by), "g", "o", "w", total, limit).collect()}
    assert got == {(g, i): b for g, ws in by.items() for i, b in enumerate(serial_sequential(ws, total, limit))}


@pytest.mark.parametrize("limit", [100, 3, 10**6])
def test_even(spark, limit):
    by = groups(2)
    got = {(r.g, r.o): r.batch for r in batching.even_batches(frame(spark, by), "g", "o", "w", limit).collect()}
    assert got == {(g, i): b for g, ws in by.items() for i, b in enumerate(serial_even(ws, limit))}


def test_pouring_equals_the_heap():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice([0, 1, 2, 5, 5, 5, 40, 41]) for _ in range(rng.randrange(1, 120))]
        limit = rng.choice([1, 3, 10, 50, 1000])
        weights = sorted(set(words), reverse=True)
        slots = [(-w, load + m * w, b) for w, b, load, n in batching._poured(weights, [words.count(w) for w in weights], limit) for m in range(n)]
        dealt = [b for _, _, b in sorted(slots)]
        order = sorted(range(len(words)), key=lambda i: (-words[i], i))
        want = serial_even(words, limit)
        assert dealt == [want[i] for i in order]


def test_running_sums_and_empty_tables(spark):
    rows = spark.range(1000).withColumn("v", F.col("id") % 7).repartition(5)
    got = [(r.s, r.n) for r in running(rows, {"s": F.col("v"), "n": F.lit(1)}, F.col("id").desc()).orderBy(F.col("id").desc()).collect()]
    upto, want = 0, []
    for i in reversed(range(1000)):
        upto += i % 7
        want.append((upto, 1000 - i))
    assert got == want
    empty = frame(spark, {"a": [1]}).limit(0)
    assert batching.sequential_batches(empty, "g", "o", "w", 0, 5).count() == batching.even_batches(empty, "g", "o", "w", 5).count() == 0
