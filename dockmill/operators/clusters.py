"""Stored clusterings: writing them, their statistics and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.operators.similarity import distinct_pairs
from dockmill.plans.ordering import numbered, running
from dockmill.plans.shared import discard, materialize
from dockmill.sources.store import Store

BLOCK_BITS = 12  # consecutive rows whose maxima run in one task


def clustering(clusters: DataFrame, length: Column, least: int, threshold: float, method: str = "word-ngrams") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(``comment_clusters``, ``comment_cluster_membership``, ``clustering_status``) of (``k``, ``leader``) with what ``length`` needs.

    Members of clusters below ``least`` stand alone.  Clusters are numbered from
    1 in the order of their first member; the longest member represents, the
    first of equally long ones.
    """
    sizes = clusters.groupBy("leader").agg(F.count("*").alias("__n"))
    alone = F.col("__n") < least
    members = clusters.withColumn("__len", length).join(sizes, "leader").select("k", "__len", F.when(alone, F.col("k")).otherwise(F.col("leader")).alias("leader"))
    longest = F.min(F.struct((-F.col("__len")).alias("n"), F.col("k").alias("k")))
    per = members.groupBy("leader").agg(F.min("k").alias("__first"), F.count("*").alias("cluster_size"), longest.alias("__rep"))
    per = per.select("leader", "__first", "cluster_size", F.col("__rep.k").alias("representative_comment_id"))
    table = numbered(per, "cluster_id", "__first", start=1)
    full = table.select("cluster_id", "representative_comment_id", "cluster_size", F.lit(threshold).alias("similarity_threshold"), F.lit(method).alias("cluster_method"))
    membership = members.join(table.select("leader", "cluster_id", "representative_comment_id"), "leader")
    membership = membership.select(F.col("k").alias("comment_id"), "cluster_id", (F.col("k") == F.col("representative_comment_id")).alias("is_representative"), F.lit(1.0).alias("similarity_score"))
    totals = full.agg(F.coalesce(F.sum("cluster_size"), F.lit(0)).alias("total_comments"), F.count("*").alias("total_clusters"))
    status = totals.select(
        "total_comments",
        "total_clusters",
        F.col("total_clusters").alias("representative_count"),
        (F.col("total_comments") - F.col("total_clusters")).alias("duplicates_filtered"),
        F.lit(threshold).alias("similarity_threshold"),
        F.lit(least).alias("min_cluster_size"),
        F.lit(method).alias("cluster_method"),
        F.lit("completed").alias("status"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("completed_at"),
    )
    return full, membership, status


def store_clustering(store: Store, clusters: DataFrame, length: Column, least: int, threshold: float, method: str = "word-ngrams") -> None:
    """Replace the stored clustering; the run's status is added last, so a run that dies is no completed one."""
    tables = clustering(clusters, length, least, threshold, method)
    for name, df in zip(("comment_clusters", "comment_cluster_membership"), tables, strict=False):
        store.overwrite(name, df)
    status = tables[2]
    store.overwrite("clustering_status", store.read("clustering_status").unionByName(status) if store.exists("clustering_status") else status)


def has_run(status: DataFrame) -> bool:
    """Whether any clustering run is completed."""
    return not status.where("status = 'completed'").isEmpty()


def latest_run(status: DataFrame, clusters: DataFrame) -> DataFrame:
    """The last completed run with the size of the largest stored cluster; no row without a run."""
    last = status.where("status = 'completed'").orderBy(F.desc("created_at")).limit(1)
    return last.crossJoin(clusters.agg(F.max("cluster_size").alias("largest_cluster_size")))  # one row each


def representative_ids(status: DataFrame, membership: DataFrame) -> DataFrame:
    """Ids of representatives; raises without a completed run."""
    if not has_run(status):
        raise LookupError("no completed clustering run")
    return membership.where("is_representative").select("comment_id")


def sizes_of(comments: DataFrame, membership: DataFrame, clusters: DataFrame, key: str = "id") -> DataFrame:
    """(``key``, ``cluster_size``): 1 for a comment without a cluster."""
    own = membership.select(F.col("comment_id").alias("__c"), "cluster_id").join(clusters.select("cluster_id", "cluster_size"), "cluster_id")
    return comments.select(key).join(own, F.col(key) == F.col("__c"), "left").select(key, F.coalesce(F.nullif("cluster_size", F.lit(0)), F.lit(1)).alias("cluster_size"))


def representing(comments: DataFrame, membership: DataFrame, key: str = "id") -> DataFrame:
    """The comments that represent their cluster."""
    reps = membership.where("is_representative").select(F.col("comment_id").alias("__c"))
    return comments.join(reps, F.col(key) == F.col("__c"), "left_semi")


def top_sizes(membership: DataFrame, k: int = 5) -> DataFrame:
    """(``size``, ``clusters``, ``comments``) of the ``k`` largest sizes."""
    per = membership.groupBy("cluster_id").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))
    return per.withColumn("comments", F.col("size") * F.col("clusters")).orderBy(F.desc("size")).limit(k)


def summary(comments: DataFrame) -> DataFrame:
    """(``has_clustering``, ``distinct_comments``, ``total_comments``): representatives, or all comments if none is marked."""
    counts = comments.agg(F.count_if(F.coalesce("is_representative", F.lit(False))).alias("reps"), F.count("*").alias("total_comments"))
    return counts.select((F.col("reps") > 0).alias("has_clustering"), F.when(F.col("reps") > 0, F.col("reps")).otherwise(F.col("total_comments")).alias("distinct_comments"), "total_comments")


def to_extract(condensed: DataFrame, membership: DataFrame, clusters: DataFrame, transcriptions: DataFrame, extracts: DataFrame) -> DataFrame:
    """(``comment_id``, ``structured_sections``, ``markdown``, ``cluster_size``) of completed representatives without an extract."""
    done = condensed.where("status = 'completed'").select("comment_id", "structured_sections")
    reps = membership.where("is_representative").select("comment_id", "cluster_id").join(clusters.select("cluster_id", "cluster_size"), "cluster_id").drop("cluster_id")
    texts = transcriptions.where("status = 'completed'").select("comment_id", "markdown")
    open_ = done.join(extracts.select("comment_id").distinct(), "comment_id", "left_anti")
    return open_.join(reps, "comment_id").join(texts, "comment_id", "left").dropDuplicates(["comment_id"])


def badge(size: Column, is_representative: Column) -> Column:
    """What a representative's card says about its cluster."""
    text = F.when(size > 100, F.concat(size.cast("string"), F.lit(" aligned"))).otherwise(F.concat(F.lit("+"), (size - 1).cast("string"), F.lit(" similar")))
    return F.when((size > 1) & F.coalesce(is_representative, F.lit(False)), text)


def caption(shown: DataFrame, comments: DataFrame) -> DataFrame:
    """One line about a result: clusters that stand for comments, or comments of all."""
    n = shown.agg(F.count("*").alias("n"))
    total = comments.agg(F.count("*").alias("total"), F.count("is_representative").alias("marked"))
    head = F.concat(F.lit("Showing "), F.col("n").cast("string"))
    text = F.when(F.col("marked") > 0, F.concat(head, F.lit(" clusters representing "), F.col("total").cast("string"), F.lit(" comments"))).otherwise(F.concat(head, F.lit(" of "), F.col("total").cast("string"), F.lit(" comments")))
    return n.crossJoin(total).select(text.alias("caption"))  # one row each


def _records(state: DataFrame) -> DataFrame:
    """(``c``, ``node``, ``at``, ``until``): each cluster's longest members in turn, and the row that takes over.

    Maxima run inside blocks of consecutive rows and over blocks, so a large
    cluster is no single task.
    """
    blocked = state.withColumn("block", F.shiftright("i", BLOCK_BITS))
    tops = blocked.groupBy("c", "block").agg(F.max("n").alias("top"))
    before = tops.select("c", "block", F.max("top").over(Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = F.max("n").over(Window.partitionBy("c", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    seen = blocked.withColumn("inside", inside).join(before, ["c", "block"])
    new = seen.where(F.coalesce(F.col("n") > F.greatest("inside", "before"), F.lit(True)))
    return new.select("c", "node", F.col("i").alias("at"), F.lead("i").over(Window.partitionBy("c").orderBy("i")).alias("until"))


def first_match_clusters(rows: DataFrame, group: str, order: str, words: str, length: str, threshold: float = 0.8) -> DataFrame:
    """(``group``, ``order``, ``cluster``) by first match: a row joins the first cluster whose longest member is similar, else it founds one.

    The longest member changes as a cluster grows, so where a row goes depends on
    rows before it.  Starting from rows that stand alone, each round works out
    every row's cluster from all clusters of the round before: which members were
    the longest and for which rows, and which of them are similar to the row.  Rows
    that depend on rows that are right are right, so the rounds end, after as many
    as the longest chain of such dependencies, in what the serial pass gives.
    Similar sets are found once, over distinct sets; a group may be the whole
    table.  ``words``: arrays of words; two empty ones are not similar.
    """
    tagged = F.transform(F.array_distinct(words), lambda w: F.concat(F.coalesce(F.col(group).cast("string"), F.lit("")), F.lit("\x01"), F.col(group).isNull().cast("string"), F.lit("\x01"), w))
    placed = numbered(rows.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(length), F.lit(0)).alias("n"), F.sort_array(tagged).alias("f")), "i", "g", "o")
    placed = materialize(placed, "rows")
    distinct = materialize(placed.where(F.size("f") > 0).groupBy("f").agg(F.min("i").alias("node")), "sets")
    member = materialize(placed.join(distinct, "f", "left").select("g", "o", "i", "n", "node"), "members")
    pairs = materialize(distinct_pairs(distinct, threshold).select("x", "y"), "pairs")
    beside = materialize(pairs.unionAll(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).unionAll(distinct.select(F.col("node").alias("x"), F.col("node").alias("y"))), "beside")
    state = materialize(member.select("i", "n", "node", F.col("i").alias("c")), "state")
    while True:
        near = _records(state).join(beside.withColumnRenamed("x", "node"), "node").select("y", "c", "at", "until")
        joining = member.select(F.col("i").alias("r"), F.col("node").alias("y")).join(near, "y").where((F.col("r") > F.col("at")) & (F.col("until").isNull() | (F.col("r") <= F.col("until"))))
        first = joining.groupBy("r").agg(F.min("c").alias("to"))
        fresh = materialize(state.join(first, F.col("i") == F.col("r"), "left").select("i", "n", "node", F.coalesce("to", "i").alias("c"), F.col("c").alias("old")), "state")
        discard(state)
        state = fresh
        if not fresh.where("c <> old").limit(1).count():
            break
    founders = running(member.select("g", "i").join(state.where("c = i").select("i"), "i"), {"nr": F.lit(1).cast("long")}, "i")
    founders = materialize(founders.select("g", F.col("i").alias("c"), "nr"), "founders")
    least = founders.groupBy("g").agg(F.min("nr").alias("least")).withColumnRenamed("g", "__g")
    number = founders.join(least, F.col("g").eqNullSafe(F.col("__g"))).select("c", (F.col("nr") - F.col("least")).alias("cluster"))
    return member.select("g", "o", "i").join(state.select("i", "c"), "i").join(number, "c").select(F.col("g").alias(group), F.col("o").alias(order), "cluster")
