"""Relational core: loading joins, work queues, statistics, counts, exports.

Fan-outs are aggregated before they are joined, so joins stay one to one, and
existence tests are semi and anti joins.  Nothing here asks for a broadcast: the
planner does where statistics allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.functions.text import first_given, given


def after_offset(rows: DataFrame, stored: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of a file beyond as many as are stored already, ``limit`` at most."""
    n = stored.agg(F.count("*").alias("__n"))
    rest = rows.crossJoin(n).where(F.col("ord") > F.col("__n")).drop("__n")  # one row on the right
    return rest if limit is None else rest.orderBy("ord").limit(limit)


def only_new(rows: DataFrame, stored: DataFrame, key: str, limit: int | None = None, order: str = "ord") -> DataFrame:
    """Rows whose key is not stored, as many as ``limit`` leaves room for; none if it is used up."""
    new = rows.join(stored.select(key).distinct(), key, "left_anti")
    if limit is None:
        return new
    room = stored.agg(F.greatest(F.lit(limit) - F.count("*"), F.lit(0)).alias("__room"))
    ranked = new.orderBy(order).limit(limit).withColumn("__nr", F.row_number().over(Window.orderBy(order)))  # limit rows at most
    return ranked.crossJoin(room).where("__nr <= __room").drop("__nr", "__room")


def with_attachments(comments: DataFrame, attachments: DataFrame) -> DataFrame:
    """Comments with their attachments as an array in order of id."""
    per = attachments.groupBy("comment_id").agg(F.array_sort(F.collect_list(F.struct("id", "format"))).alias("attachments"))
    return comments.join(per, comments.id == per.comment_id, "left").drop("comment_id")


def load_comments(comments: DataFrame, attachments: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(comments with their attachments, ``limit`` at most in the order they came in; one row with the ``total`` of all)."""
    chosen = comments if limit is None else comments.orderBy("ord").limit(limit)
    wanted = attachments if limit is None else attachments.join(chosen.select(F.col("id").alias("comment_id")), "comment_id", "left_semi")
    return with_attachments(chosen, wanted), comments.agg(F.count("*").alias("total"))


def condensed_content(comments: DataFrame, condensed: DataFrame, transcriptions: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Completed condensed comments; content is the transcription, else position, recommendations and concerns."""
    done = condensed.where("status = 'completed'").select(F.col("comment_id").alias("__c"), "structured_sections")
    text = transcriptions.where("status = 'completed'").select(F.col("comment_id").alias("__t"), "markdown")
    out = comments.join(done, F.col("id") == F.col("__c")).join(text, F.col("id") == F.col("__t"), "left")
    if ids is not None:  # an empty set of ids means no filter
        out = out.join(ids.select(F.col("id")).distinct(), "id", "left_semi")
    s = F.col("structured_sections")
    parts = F.concat_ws("\n\n", given(s.corePosition), given(s.keyRecommendations), given(s.mainConcerns))
    return out.withColumn("content", F.coalesce(given("markdown"), parts)).drop("__c", "__t")


def joined_texts(rows: DataFrame, by: list[Column], order: str, text: Column, separator: str) -> DataFrame:
    """``text`` of each group: its rows' texts in ``order``, then by themselves; a missing one counts as empty."""
    per = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(text, F.lit("")).alias("t")))).alias("x"))
    return per.withColumn("text", F.array_join(F.transform("x", lambda e: e.t), separator)).drop("x")


def best_by(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """One row a group: the first in ``order``."""
    nr = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("__nr", nr).where("__nr = 1").drop("__nr")


def best_attachment(attachments: DataFrame, ranking: list[str], key: str = "id") -> DataFrame:
    """Per attachment id the format that stands last in ``ranking``; unknown formats come after known ones."""
    rank = F.array_position(F.array(*(F.lit(f) for f in ranking)), F.col("format"))
    return best_by(attachments, key, [rank.desc(), F.col("ord")])


def transcription_source(attachments: DataFrame, native: list[str]) -> DataFrame:
    """Per attachment the format to transcribe: a native one with data, else docx, else txt; others are dropped."""
    with_data = F.col("blob_data").isNotNull()
    rank = F.when(F.col("format").isin(native) & with_data, 0).when((F.col("format") == "docx") & with_data, 1).when((F.col("format") == "txt") & with_data, 2)
    return best_by(attachments.withColumn("__rank", rank).where("__rank is not null"), "id", [F.col("__rank"), F.col("ord")]).drop("__rank")


def pending(items: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """Items without a status row, or whose status is pending or processing."""
    s = status.select(F.col("comment_id").alias("__k"), F.col("status").alias("__s"))
    return items.join(s, F.col(key) == F.col("__k"), "left").where("__k is null or __s in ('pending', 'processing')").drop("__k", "__s")


def failed(items: DataFrame, status: DataFrame, key: str, representatives: DataFrame | None = None) -> DataFrame:
    """Failed items in order of attempts, restricted to representatives if given."""
    s = status.where("status = 'failed'").select(F.col("comment_id").alias("__k"), "attempt_count")
    out = items.join(s, F.col(key) == F.col("__k")).drop("__k")
    if representatives is not None:
        out = out.join(representatives, out[key] == representatives.comment_id, "left_semi")
    return out.orderBy("attempt_count", key)


def status_summary(status: DataFrame) -> DataFrame:
    """Totals by status; sums of an empty table are NULL, its count 0."""
    one = lambda *s: F.sum(F.when(F.col("status").isin(*s), 1).otherwise(0))
    return status.agg(F.count("*").alias("total"), one("completed").alias("completed"), one("failed").alias("failed"), one("pending", "processing").alias("pending"))


def unprocessed(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key has no row in ``done``."""
    return items.join(done.select(F.col("comment_id").alias(key)).distinct(), key, "left_anti")


def theme_counts(themes: DataFrame, extracts: DataFrame) -> DataFrame:
    """Themes with the number of comments, weighted by cluster size; 0 without any."""
    per = extracts.groupBy("theme_code").agg(F.coalesce(F.sum("cluster_size"), F.countDistinct(F.when(F.col("cluster_size").isNull(), F.col("comment_id")))).alias("comment_count"))  # counted only where no size is given
    joined = themes.join(per, themes.code == per.theme_code, "left").drop("theme_code")
    return joined.withColumn("comment_count", F.coalesce("comment_count", F.lit(0)))


def summary_counts(summaries: DataFrame, themes: DataFrame, extracts: DataFrame) -> DataFrame:
    """Summaries with their theme's label and weighted count, the stored count where no extract is left."""
    per = extracts.groupBy("theme_code").agg(F.sum("cluster_size").alias("weighted"))
    out = summaries.join(themes.select("code", "description"), summaries.theme_code == themes.code).drop("code")
    return out.join(per, "theme_code", "left").withColumn("comment_count", F.coalesce("weighted", "comment_count")).drop("weighted")


def themes_with_at_least(extracts: DataFrame, n: int, codes: list[str] | None = None) -> DataFrame:
    """Themes with ``n`` or more distinct comments, largest first."""
    rows = extracts if codes is None else extracts.where(F.col("theme_code").isin(codes))
    return rows.groupBy("theme_code").agg(F.countDistinct("comment_id").alias("comment_count")).where(F.col("comment_count") >= n).orderBy(F.desc("comment_count"), "theme_code")


def entity_weights(taxonomy: DataFrame, mentions: DataFrame, membership: DataFrame, strict: bool = True) -> DataFrame:
    """Entities with the sum of the cluster sizes of the comments that mention them.

    ``strict`` keeps the counting of an outer join: an entity without mentions
    has one empty row and so weight 1.  Otherwise each cluster counts once and
    an unmentioned entity has 0.
    """
    sized = mentions.join(membership.select("comment_id", "cluster_id", "cluster_size"), "comment_id", "left")
    size = F.coalesce("cluster_size", F.lit(1))
    if strict:
        per = sized.groupBy("category", "entity_label").agg(F.sum(size).alias("mention_count"))
        default = 1
    else:
        once = sized.withColumn("__c", F.coalesce(F.concat(F.lit("c"), F.col("cluster_id").cast("string")), F.concat(F.lit("d"), F.col("comment_id").cast("string"))))
        per = once.groupBy("category", "entity_label", "__c").agg(F.max(size).alias("s")).groupBy("category", "entity_label").agg(F.sum("s").alias("mention_count"))
        default = 0
    out = taxonomy.join(per.withColumnRenamed("entity_label", "label"), ["category", "label"], "left")
    return out.withColumn("mention_count", F.coalesce("mention_count", F.lit(default)))


def export_comments(comments: DataFrame, extracts: DataFrame, entities: DataFrame, membership: DataFrame) -> DataFrame:
    """One record a comment; a cluster member without themes of its own shows its representative's."""
    themes = extracts.groupBy("comment_id").agg(F.array_sort(F.collect_set("theme_code")).alias("codes"))
    named = entities.groupBy("comment_id").agg(F.array_sort(F.collect_set(F.struct("category", F.col("entity_label").alias("label")))).alias("entities"))
    reps = membership.where("is_representative").select("cluster_id", F.col("comment_id").alias("rep_id"))
    own = membership.join(reps, "cluster_id", "left").select("comment_id", "cluster_size", "is_representative", "rep_id")
    out = comments.join(own, comments.id == own.comment_id, "left").drop("comment_id")
    out = out.join(themes.select(F.col("comment_id").alias("id"), F.col("codes").alias("own_codes")), "id", "left")
    out = out.join(themes.select(F.col("comment_id").alias("rep_id"), F.col("codes").alias("rep_codes")), "rep_id", "left")
    out = out.join(named.select(F.col("comment_id").alias("id"), "entities"), "id", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "id",
        F.coalesce(F.col("cluster_size").cast("long"), F.lit(1).cast("long")).alias("cluster_size"),
        F.col("is_representative").alias("is_cluster_representative"),
        F.col("rep_id").alias("cluster_representative_id"),
        F.coalesce("own_codes", "rep_codes", none).alias("theme_codes"),
        (F.col("own_codes").isNull() & F.col("rep_codes").isNotNull()).alias("is_aligned_summary"),
        F.coalesce("entities", F.array().cast("array<struct<category:string,label:string>>")).alias("entities"),
    )


def shown_sections(sections: Column, transcription: Column) -> Column:
    """A comment's sections; a transcription takes the place of the detailed content."""
    none = F.create_map().cast("map<string,string>")
    others = F.map_filter(F.coalesce(sections, none), lambda k, _: k != "detailedContent")
    return F.when(given(transcription).isNull(), sections).otherwise(F.map_concat(others, F.create_map(F.lit("detailedContent"), transcription)))


def export_records(comments: DataFrame, extracts: DataFrame, entities: DataFrame, membership: DataFrame) -> DataFrame:
    """The records of a browser's comment list, one a comment.

    ``comments``: ``id``, ``document_id``, ``attributes_json``, ``word_count``,
    ``structured_sections`` (map), ``transcription_markdown``, ``attachment_count``.
    """
    at = lambda name: given(F.get_json_object("attributes_json", f"$.{name}"))
    linked = export_comments(comments.select("id"), extracts, entities, membership)
    organization, names = at("organization"), given(F.trim(F.concat_ws(" ", at("firstName"), at("lastName"))))
    own = comments.select(
        "id",
        "document_id",
        F.coalesce(organization, names, F.lit("Anonymous")).alias("submitter"),
        F.coalesce(at("category"), F.when(organization.isNotNull(), "Organization").otherwise("Individual")).alias("submitter_type"),
        F.coalesce(at("postedDate"), at("receiveDate")).alias("date"),
        F.concat_ws(", ", at("city"), at("stateProvinceRegion"), at("country")).alias("location"),
        shown_sections(F.col("structured_sections"), F.col("transcription_markdown")).alias("structured_sections"),
        (F.coalesce("attachment_count", F.lit(0)) > 0).alias("has_attachments"),
        F.coalesce(F.col("word_count").cast("long"), F.lit(0).cast("long")).alias("word_count"),
    )
    return own.join(linked.withColumn("theme_scores", theme_scores(F.col("theme_codes"))).drop("theme_codes"), "id")


def theme_scores(codes: Column) -> Column:
    """Map from each theme code to 1."""
    return F.map_from_arrays(codes, F.transform(codes, lambda c: F.lit(1)))


def cluster_report(membership: DataFrame, least: int = 2) -> DataFrame:
    """Clusters of at least ``least`` members with their representative and sorted members."""
    per = membership.groupBy("cluster_id").agg(
        F.count("*").alias("size"),
        F.max(F.when(F.col("is_representative"), F.col("comment_id"))).alias("representative_id"),
        F.array_sort(F.collect_list("comment_id")).alias("members"),
    )
    return per.where(F.col("size") >= least).orderBy(F.desc("size"), "cluster_id")


def cluster_sizes(membership: DataFrame) -> DataFrame:
    """How many clusters have which size."""
    return membership.groupBy("cluster_id").count().groupBy(F.col("count").alias("size")).agg(F.count("*").alias("clusters"))


def cluster_statistics(membership: DataFrame) -> DataFrame:
    """Totals, duplicates and reduction of a clustering."""
    per = membership.groupBy("cluster_id").agg(F.count("*").alias("size"))
    out = per.agg(F.sum("size").alias("total"), F.count("*").alias("clusters"), F.max("size").alias("largest"))
    out = out.withColumn("duplicates", F.col("total") - F.col("clusters"))
    return out.withColumn("reduction_pct", F.round(100 * F.col("duplicates") / F.col("total"), 1))


def total_submissions(membership: DataFrame, comments: DataFrame) -> DataFrame:
    """Sum of the clusters' sizes, each cluster once; the number of comments where that is 0 or missing."""
    once = membership.select("cluster_id", "cluster_size").distinct().agg(F.sum("cluster_size").alias("s"))
    return once.crossJoin(comments.agg(F.count("*").alias("n"))).select(F.coalesce(F.nullif("s", F.lit(0)), "n").cast("long").alias("total_submissions"))  # one row each


def coverage(themes: DataFrame, extracts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` themes with the most distinct comments."""
    per = extracts.groupBy("theme_code").agg(F.countDistinct("comment_id").alias("comments"))
    out = themes.join(per, themes.code == per.theme_code, "left").select("code", F.coalesce("comments", F.lit(0)).alias("comments"))
    return out.orderBy(F.desc("comments"), "code").limit(k)


def cache_statistics(cache: DataFrame) -> DataFrame:
    """Entries and their time span by task type and level."""
    return cache.groupBy("task_type", "task_level").agg(F.count("*").alias("entries"), F.min("created_at").alias("oldest"), F.max("created_at").alias("newest"))


def cache_size(cache: DataFrame) -> DataFrame:
    """Characters of all entries; an entry with a NULL among its texts adds nothing."""
    return cache.agg(F.sum(F.length("prompt_hash") + F.length("task_type") + F.length("task_params") + F.length("result")).alias("characters"))


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def expire(cache: DataFrame, condition: Column) -> DataFrame:
    """The entries that stay when those under ``condition`` are deleted."""
    return cache.where(~F.coalesce(condition, F.lit(False)))


def inverted_index(pairs: DataFrame, key: list[str], value: str) -> DataFrame:
    """Distinct sorted values by key."""
    return pairs.groupBy(*key).agg(F.array_sort(F.collect_set(value)).alias(f"{value}s"))


def children(themes: DataFrame) -> DataFrame:
    per = themes.where("parent_code is not null").groupBy(F.col("parent_code").alias("code")).agg(F.array_sort(F.collect_list("code")).alias("children"))
    return themes.select("code").join(per, "code", "left").withColumn("children", F.coalesce("children", F.array().cast("array<string>")))


def ancestors(themes: DataFrame) -> DataFrame:
    """(code, ancestor, depth): existing codes that are proper dotted prefixes."""
    parts = F.split("code", r"\.")
    prefixes = themes.select("code", F.explode(F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))).alias("depth"))
    prefixes = prefixes.withColumn("ancestor", F.array_join(F.slice(F.split("code", r"\."), F.lit(1), F.col("depth")), "."))
    return prefixes.join(themes.select(F.col("code").alias("ancestor")), "ancestor", "left_semi").select("code", "ancestor", "depth")


def latest_wins(old: DataFrame, new: DataFrame, key: list[str], version: str = "version") -> DataFrame:
    """Upsert: rows of ``new`` replace those of ``old`` with the same key; of repeats in ``new`` the last by ``version``."""
    both = old.unionByName(new)
    nr = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(version)))
    return both.withColumn("__nr", nr).where("__nr = 1").drop("__nr")


def fold_status(log: DataFrame) -> DataFrame:
    """Current status, attempts (failures) and error of each item from its log of events."""
    latest = F.max_by(F.struct("status", "error_message"), "version")
    out = log.groupBy("comment_id").agg(latest.alias("last"), F.count_if(F.col("status") == "failed").alias("attempt_count"))
    return out.select("comment_id", "last.status", "attempt_count", F.when(F.col("last.status") != "completed", F.col("last.error_message")).alias("error_message"))


def insert_ignore(stored: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New distinct rows whose key is not stored."""
    return new.dropDuplicates(key).join(stored.select(*key).distinct(), key, "left_anti")


def fill_word_counts(rows: DataFrame, texts: DataFrame, key: str, count: Column) -> DataFrame:
    """``word_count`` set where it is missing or 0."""
    counted = texts.select(key, count.alias("__n"))
    return rows.join(counted, key, "left").withColumn("word_count", F.coalesce(F.nullif("word_count", F.lit(0)), "__n")).drop("__n")


def last_posted(comments: DataFrame) -> DataFrame:
    return comments.agg(F.max(F.get_json_object("attributes_json", "$.postedDate")).alias("last_posted"))


def aligned_catalogue(collections: DataFrame) -> DataFrame:
    """Catalogue of collections, latest first."""
    return collections.withColumn("title", first_given("title", "document_id")).withColumn("agency", first_given("agency_name", "agency_id", F.lit("Unknown"))).orderBy(F.desc("last_date"), "document_id")


def catalogue_rows(comments: DataFrame, metadata: DataFrame, themes: DataFrame, entities: DataFrame) -> DataFrame:
    """One row a collection (``document_id`` in all four), latest first: its names, counts and the date of its last comment.

    The date is the end of the comment period, or that of the latest comment where no
    end is known.  Of several rows of ``metadata`` for a collection the first by title counts.
    """
    count = lambda rows, name: rows.groupBy("document_id").agg(F.count("*").alias(name))
    per = comments.groupBy("document_id").agg(F.count("*").alias("comment_count"), F.max(F.get_json_object("attributes_json", "$.postedDate")).alias("__latest"))
    known = metadata.groupBy("document_id").agg(F.min_by(F.struct("title", "agency_name", "agency_id", "comment_end_date", "docket_id"), F.struct("title", "docket_id")).alias("__m"))
    out = per.join(known, "document_id", "full").join(count(themes, "theme_count"), "document_id", "left").join(count(entities, "entity_count"), "document_id", "left")
    named = lambda *names: [given(F.col(f"__m.{n}")) for n in names]
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("comment_count", "theme_count", "entity_count")]
    return out.select(
        F.coalesce(*named("docket_id"), "document_id").alias("id"),
        F.coalesce(*named("title"), "document_id").alias("title"),
        F.coalesce(*named("agency_name", "agency_id"), F.lit("Unknown Agency")).alias("agency"),
        *counts,
        F.coalesce(*named("comment_end_date"), given(F.col("__latest")), F.lit("")).alias("last_comment_date"),
    ).orderBy(F.desc("last_comment_date"), "id")
