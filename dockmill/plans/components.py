"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.plans.shared import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for each node of ``edges`` (``a``, ``b``: long); the root is the smallest reachable node.

    Each round takes the smallest label among neighbours and then the label of
    that label, so paths halve; every round is a table in the shared folder.  A
    hub's edges are split as a skewed key of plain joins, and nothing is gathered
    per node but a minimum.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    while True:
        # The smallest label around each node; its own is known to lie in the component as well.
        around = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(around, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("next"))
        ahead = labels.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
        fresh = materialize(lower.join(ahead, F.col("next") == F.col("__n")).select("node", "old", F.least("next", "__r").alias("root")), "labels")
        moved = fresh.where("root <> old").limit(1).count()
        discard(labels)
        labels = fresh.select("node", "root")
        labels._dockmill_path = fresh._dockmill_path
        if not moved:
            discard(both)
            return labels
