"""Interval labels against walks of the tree."""

import random

import pytest
from pyspark.sql import functions as F

from dockmill.operators.hierarchy import ancestors, labelled, rollup, subtree


def forest(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([None, 999, *range(max(0, i - 12), i)]) if i % 3 else (i - 1 if i else None), rng.randrange(5), rng.choice([None, 1, 2, 7])) for i in range(n)]


@pytest.mark.parametrize("n,seed", [(1, 1), (60, 2), (90, 3)])
def test_labels_subtrees_and_rollups(spark, n, seed):
    rows = forest(n, seed)
    random.Random(seed).shuffle(rows)
    nodes = spark.createDataFrame(rows, "id long, up long, rank int, w long").repartition(3)
    parent = {i: p for i, p, _, _ in rows}
    line = lambda i: [i, *line(parent[i])] if i in parent else []
    labels = labelled(nodes, "id", "up", "rank")
    got = {r.id: r for r in labels.collect()}
    inside = {i: {j for j in parent if i in line(j)} for i in parent}
    for i, r in got.items():
        assert {j for j, x in got.items() if r.enter <= x.enter <= r.leave} == inside[i] and r.depth == len(line(i)) - 1
    order = {i: (x, i) for i, _, x, _ in rows}
    assert [i for i in sorted(got, key=lambda i: got[i].enter)] == sorted(parent, key=lambda i: [order[j] for j in reversed(line(i))])
    weight = {i: w or 0 for i, _, _, w in rows}
    totals = {r.id: (r.total, r.n) for r in rollup(labels, total=F.col("w"), n=F.lit(1)).collect()}
    assert totals == {i: (sum(weight[j] for j in inside[i]), len(inside[i])) for i in parent}
    some = F.col("id").isin(0, n // 2)
    assert {r.id for r in subtree(labels, some).collect()} == inside[0] | inside[n // 2]


def test_cycles_repeats_and_empty_tables(spark):
    with pytest.raises(ValueError, match="cycle"):
        ancestors(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, None)], "id long, up long"), "id", "up")
    with pytest.raises(ValueError, match="repeats"):
        ancestors(spark.createDataFrame([(1, None), (1, None)], "id long, up long"), "id", "up")
    empty = spark.createDataFrame([], "id long, up long, w long")
    assert rollup(labelled(empty, "id", "up"), t=F.col("w")).count() == 0
