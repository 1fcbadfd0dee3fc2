"""Word budgets: samples, sequential and even batches, merge trees.

Items are an id and a word count, never a text.  Sequential batches come from
running sums and jumps, even batches from counts of equal weights, so a group may
be as large as the table.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from dockmill.plans.ordering import numbered, running
from dockmill.plans.shared import materialize


def budget_sample(rows: DataFrame, words: str, budget: int, key: str, filled: float = 0.9, digits: int = 4) -> DataFrame:
    """Rows in order of ``key`` until one would exceed the budget when 90 % of it is used already.

    ``key``: evenly spread hexadecimal texts, such as a hash.  A row that would
    exceed the budget earlier is taken all the same.  Sums by the key's first
    ``digits`` say which part of the order the budget reaches; the running sum
    runs over those rows only, which the budget bounds.
    """
    head = F.substring(key, 1, digits)
    sums = rows.groupBy(head.alias("__head")).agg(F.sum(words).alias("__sum"))  # 16 ** digits rows at most
    reached = sums.withColumn("__upto", F.coalesce(F.sum("__sum").over(Window.orderBy("__head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    near = rows.withColumn("__head", head).join(F.broadcast(reached.where(F.col("__upto") <= budget).select("__head")), "__head", "left_semi").drop("__head")
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    summed = near.withColumn("__b", F.coalesce(F.sum(words).over(before), F.lit(0)))
    stop = ((F.col("__b") + F.col(words) > budget) & (F.col("__b") > filled * budget)).cast("int")
    return summed.withColumn("__s", F.max(stop).over(upto)).where("__s = 0").drop("__b", "__s")


def sequential_batches(rows: DataFrame, group: str, order: str, words: str, total_limit: int, batch_limit: int) -> DataFrame:
    """``batch`` numbers from 1: a new batch where the limit would be exceeded; one batch if all fits ``total_limit``.

    A batch that began with item i ends before the first item whose running sum
    exceeds that before i by more than the limit, so every item has a successor:
    the item that would begin the next batch if it began one.  Running sums find
    the successors, and those that follow each other from a group's first item are
    found by doubling: each round joins jumps of 2, 4, 8 ... batches, as many
    rounds as the most batches of a group have bits.  Groups may be of any size.
    """
    items = rows.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(words).cast("long"), F.lit(0)).alias("w"))
    items = materialize(running(items, {"upto": F.col("w"), "i": F.lit(1).cast("long")}, "g", "o", "w"), "items")
    per = items.groupBy("g").agg(F.min("i").alias("first"), F.max("i").alias("last"), F.sum("w").alias("total")).where(F.col("total") > total_limit)
    cut = items.join(per.withColumnRenamed("g", "__g"), F.col("g").eqNullSafe(F.col("__g")))
    before = F.col("upto") - F.col("w")
    # How many items have a sum up to that before i, and up to that and the limit.
    asked = cut.select("i", "first", "last", F.explode(F.array(F.struct(before.alias("v"), F.lit(0).alias("kind")), F.struct((before + batch_limit).alias("v"), F.lit(1).alias("kind")))).alias("q"))
    line = items.select(F.col("upto").alias("v"), F.lit(-1).alias("kind"), "i", F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("last")).unionAll(asked.select("q.v", "q.kind", "i", "first", "last"))
    counted = running(line, {"n": (F.col("kind") < 0).cast("long")}, "v", "kind", "i").where("kind >= 0")
    over = F.max(F.when(F.col("kind") == 1, F.col("n"))) + 1
    # An item above the limit, with nothing or only empty ones before it, fills a batch of its own.
    next_ = over + F.when(F.max(F.when(F.col("kind") == 0, F.col("n"))) < over - 1, 0).otherwise(1)
    jump = materialize(counted.groupBy("i", "first", "last").agg(next_.alias("to")).where(F.col("to") <= F.col("last")).select("i", "to"), "jumps")
    jumps = [jump]
    while jumps[-1].limit(1).count():
        again = jumps[-1].select(F.col("i").alias("to"), F.col("to").alias("on"))
        jumps.append(materialize(jumps[-1].join(again, "to").select("i", F.col("on").alias("to")), "jumps"))
    starts = items.groupBy("g").agg(F.min("i").alias("i")).select("i")
    for jump in reversed(jumps[:-1]):
        starts = materialize(starts.unionAll(starts.join(jump, "i").select(F.col("to").alias("i"))), "starts")
    marked = items.select("g", "o", "i").join(starts.withColumn("start", F.lit(1)), "i", "left")
    numbered = materialize(running(marked, {"n": F.coalesce("start", F.lit(0)).cast("long")}, "i"), "batches")
    least = numbered.groupBy("g").agg(F.min("n").alias("least")).withColumnRenamed("g", "__g")
    return numbered.join(least, F.col("g").eqNullSafe(F.col("__g"))).select(F.col("g").alias(group), F.col("o").alias(order), (F.col("n") - F.col("least") + 1).alias("batch"))


def _poured(weights: list[int], counts: list[int], batch_limit: int) -> list[tuple[int, int, int, int]]:
    """(weight, batch, its load before, how many items of the weight it gets) when items, largest first, each go to the smallest batch.

    ``weights`` descend.  Items of one weight w fill a batch of load l up at l, l + w,
    l + 2 w ...; of these marks of all batches the smallest are taken, as many as
    there are items.  Few items are dealt one by one, many by the level they reach.
    """
    k = max(1, -(-sum(w * c for w, c in zip(weights, counts, strict=True)) // batch_limit))
    heap, out = [(0, b) for b in range(k)], []
    for w, c in zip(weights, counts, strict=True):
        if w == 0:
            out.append((w, heap[0][1], heap[0][0], c))
        elif 8 * c < k:
            for _ in range(c):
                load, b = heap[0]
                heapq.heapreplace(heap, (load + w, b))
                out.append((w, b, load, 1))
        else:
            load = np.empty(k, dtype=np.int64)
            load[[b for _, b in heap]] = [x for x, _ in heap]
            below = lambda x: np.maximum((x - load) // w + 1, 0)  # noqa: B023, E731  marks up to x
            low, high = int(load.min()), int(load.max()) + w * (c // k + 1)
            while low < high:
                low, high = ((low + high) // 2 + 1, high) if below((low + high) // 2).sum() < c else (low, (low + high) // 2)
            n = below(low - 1)
            at = np.flatnonzero((low >= load) & ((low - load) % w == 0))[: c - int(n.sum())]
            n[at] += 1
            some = np.flatnonzero(n)
            out += zip([w] * len(some), some.tolist(), load[some].tolist(), n[some].tolist(), strict=True)
            heap = list(zip((load + n * w).tolist(), range(k), strict=True))
            heapq.heapify(heap)
    return out


def _placed(rows: list[tuple], kind: T.DataType) -> pa.RecordBatch:
    columns = [*zip(*rows, strict=True)] if rows else [()] * 5
    types = [to_arrow_type(kind), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["g", "w", "batch", "load", "n"])


def even_batches(rows: DataFrame, group: str, order: str, words: str, batch_limit: int) -> DataFrame:
    """``batch`` numbers from 0: as many batches as the words need, each item (largest first) to the smallest batch.

    A group's task sees how many items have which number of words, and says how
    many of them each batch gets from which load on; items and these places are
    then numbered in one order, by ranges, and matched by number.
    """
    items = rows.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(words).cast("long"), F.lit(0)).alias("w"))
    ranked = numbered(items, "i", "g", F.col("w").desc(), "o")
    counts = items.groupBy("g", "w").agg(F.count("*").alias("c"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come one after the other, their weights descending."""
        rows = ((g, w, c) for b in batches for g, w, c in zip(*(b.column(k).to_pylist() for k in ("g", "w", "c")), strict=True))
        out: list[tuple] = []
        for g, own in itertools.groupby(rows, key=lambda r: r[0]):
            _, weights, sizes = zip(*own, strict=True)
            out += [(g, *p) for p in _poured([*weights], [*sizes], batch_limit)]
            if len(out) >= 50_000:
                yield _placed(out, kind)
                out = []
        yield _placed(out, kind)

    kind = items.schema["g"].dataType
    schema = T.StructType([T.StructField("g", kind), *(T.StructField(c, T.LongType()) for c in ("w", "batch", "load", "n"))])
    # Several groups a task, one at a time.
    places = counts.repartition("g").sortWithinPartitions("g", F.col("w").desc()).mapInArrow(deal, schema)
    each = places.select("g", "w", "batch", "load", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("m"))
    slots = numbered(each.select("g", "w", "batch", (F.col("load") + F.col("m") * F.col("w")).alias("mark")), "i", "g", F.col("w").desc(), "mark", "batch")
    return ranked.select("g", "o", "i").join(slots.select("i", "batch"), "i").select(F.col("g").alias(group), F.col("o").alias(order), "batch")


def merge_groups(n: Column, i: Column, width: int) -> Column:
    """Group of item ``i`` (from 0) of ``n``: groups of ``width`` at most, sizes as equal as possible, larger ones first."""
    groups = F.ceil(n / width)
    base, more = F.floor(n / groups), n % groups
    return F.when(i < more * (base + 1), F.floor(i / (base + 1))).otherwise(more + F.floor((i - more * (base + 1)) / base)).cast("long")


def merge_tree(n: int, width: int) -> list[list[list[int]]]:
    """Levels of groups of item numbers until one is left; a group of one passes up."""
    levels, items = [], list(range(n))
    while len(items) > 1:
        g = -(-len(items) // width)
        base, more = divmod(len(items), g)
        cut, at = [], 0
        for k in range(g):
            size = base + (k < more)
            cut.append(items[at : at + size])
            at += size
        levels.append(cut)
        items = list(range(g))
    return levels


def merge_plan(rows: DataFrame, group: str, order: str, width: int) -> DataFrame:
    """First merge level: the merge group of each row in its order inside ``group``."""
    w = Window.partitionBy(group).orderBy(order)
    numbered = rows.withColumn("__i", F.row_number().over(w) - 1).join(rows.groupBy(group).agg(F.count("*").alias("__n")), group)
    return numbered.withColumn("merge_group", merge_groups(F.col("__n"), F.col("__i"), width)).drop("__i", "__n")
