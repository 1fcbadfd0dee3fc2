"""Consecutive numbers in an order, without sending all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.plans.shared import materialize


def numbered(rows: DataFrame, name: str, *order: Column | str, start: int = 0) -> DataFrame:
    """``rows`` with ``name``, counting from ``start`` in ``order``.

    Rows are dealt by ranges of the order and sorted inside them; a count per
    range (as many as there are partitions) gives each its first number.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "numbered")
    counts = placed.groupBy("__part").agg(F.min("__at").alias("__least"), F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__least") + start).alias("__shift"))
    return placed.join(F.broadcast(first), "__part").withColumn(name, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


def running(rows: DataFrame, sums: dict[str, Column], *order: Column | str) -> DataFrame:
    """``rows`` with running sums, each row's own value included, in ``order``.

    As in :func:`numbered`, ranges are summed side by side and the totals of the
    ranges before are added; ties of ``order`` come in any order, but in the same one
    for all sums.
    """
    values = {f"__v{i}": v for i, v in enumerate(sums.values())}
    ranged = rows.withColumns(values).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "running")
    totals = placed.groupBy("__part").agg(*(F.sum(v).alias(v) for v in values))
    before, upto = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    first = totals.select("__part", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}b") for v in values))
    inside = placed.withColumns({f"{v}s": F.sum(v).over(upto) for v in values}).join(F.broadcast(first), "__part")
    return inside.withColumns({name: F.col(f"{v}s") + F.col(f"{v}b") for name, v in zip(sums, values, strict=True)}).drop("__part", "__at", *(f"{v}{e}" for v in values for e in ("", "s", "b")))
