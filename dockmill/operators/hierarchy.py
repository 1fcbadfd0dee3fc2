"""Interval labels of a hierarchy: subtrees as ranges, rollups as differences of running sums.

A node's label is (``enter``, ``leave``): numbers in an order in which each node comes
before its descendants and these come together, so its subtree is all nodes that
enter in between.  Ancestors come from doubling (pairs of at most 1, 2, 4 ...
steps), as many rounds as the depth has bits; the order is that of the paths from
the root.  A subtree's total is the running sum up to ``leave`` less that before
``enter``, whatever the subtree's size.

Defined results: a node whose parent is null or no node is a root; siblings stand
in the order of ``order``, then of their ids; repeated ids are an error, as is a
cycle; an empty table has no labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmill.plans.ordering import numbered, running
from dockmill.plans.shared import discard, materialize


def ancestors(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(``node``, ``ancestor``, ``steps``) of every node and each of its ancestors."""
    ids = nodes.select(F.col(node).alias("node"))
    if ids.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        raise ValueError(f"{node} repeats")
    step = nodes.select(F.col(node).alias("node"), F.col(parent).alias("ancestor")).join(ids.select(F.col("node").alias("ancestor")), "ancestor", "left_semi")
    far = materialize(step.select("node", "ancestor", F.lit(1).cast("long").alias("steps")), "ancestors")
    reach, n = 1, ids.count()
    while far.where(F.col("steps") == reach).limit(1).count():
        if reach > n:
            raise ValueError("the hierarchy has a cycle")
        on = far.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("further"), F.col("steps").alias("more"))
        wider = far.where(F.col("steps") == reach).join(on, "ancestor").select("node", F.col("further").alias("ancestor"), (F.col("steps") + F.col("more")).alias("steps"))
        fresh = materialize(far.unionAll(wider), "ancestors")
        discard(far)
        far, reach = fresh, reach * 2
    return far


def labelled(nodes: DataFrame, node: str, parent: str, *order: str) -> DataFrame:
    """``nodes`` with ``enter``, ``leave`` and ``depth`` (0 at a root)."""
    up = ancestors(nodes, node, parent)
    key = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate([*order, node])))
    own = nodes.select(F.col(node).alias("node"), key.alias("key"))
    above = up.join(own.select(F.col("node").alias("ancestor"), F.col("key")), "ancestor").groupBy("node").agg(F.sort_array(F.collect_list(F.struct((-F.col("steps")).alias("s"), "key"))).alias("above"))
    below = up.groupBy(F.col("ancestor").alias("node")).agg(F.count("*").alias("below"))
    all_ = own.join(above, "node", "left").join(below, "node", "left")
    none = F.array().cast(dict(all_.dtypes)["above"])
    path = F.concat(F.transform(F.coalesce("above", none), lambda a: a["key"]), F.array("key"))
    placed = numbered(all_.select("node", path.alias("path"), F.coalesce("below", F.lit(0).cast("long")).alias("below"), F.size(F.coalesce("above", none)).alias("depth")), "enter", "path")
    labels = placed.select(F.col("node").alias("__node"), "enter", (F.col("enter") + F.col("below")).alias("leave"), "depth")
    return nodes.join(labels, F.col(node) == F.col("__node")).drop("__node")


def subtree(labels: DataFrame, of: Column) -> DataFrame:
    """The labelled nodes in the subtrees of those that ``of`` holds for, these too."""
    tops = labels.where(of).select(F.col("enter").alias("__from"), F.col("leave").alias("__to"))
    return labels.join(F.broadcast(tops) if tops.limit(1001).count() <= 1000 else tops, F.col("enter").between(F.col("__from"), F.col("__to")), "left_semi")


def rollup(labels: DataFrame, **totals: Column) -> DataFrame:
    """``labels`` with sums over each node's subtree, its own value included."""
    summed = materialize(running(labels, {f"__{name}": F.coalesce(value, F.lit(0)) for name, value in totals.items()}, "enter"), "rollup")
    upto = summed.select(F.col("enter").alias("__at"), *(F.col(f"__{name}").alias(f"__{name}_upto") for name in totals))
    out = summed.join(upto, F.col("leave") == F.col("__at")).drop("__at")
    own = {name: F.coalesce(value, F.lit(0)) for name, value in totals.items()}
    return out.select(*labels.columns, *((F.col(f"__{name}_upto") - F.col(f"__{name}") + own[name]).alias(name) for name in totals))
