"""Queries of the browser's views: theme and entity lists, summaries, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.fixtures import Views
from dockmill.functions import text as t
from dockmill.operators import collection, explore, hierarchy
from dockmill.registry import query


def _labelled(v: Views) -> DataFrame:
    return v.themes().withColumn("label", F.when(F.col("level") == 2, F.concat(F.lit("Topic "), "code")))


@query("SELECT code FROM fx_themes WHERE contains(lower(code), 'ia') OR contains(lower(description), 'ia') OR (level = 2 AND contains(lower(concat('Topic ', code)), 'ia'))")
def theme_search(v: Views) -> DataFrame:
    return explore.theme_search(_labelled(v), "IA").select("code")


@query("SELECT code FROM fx_themes WHERE level = 2 AND contains(concat('topic ', code), 'topic 1')")
def theme_search_label(v: Views) -> DataFrame:
    return explore.theme_search(_labelled(v), "Topic 1").select("code")


def _summaries(v: Views) -> DataFrame:
    counts = v.extracts().groupBy("theme_code").agg(F.count("*").alias("comment_count"))
    n = F.length("theme_code").cast("int") + F.substring("theme_code", -1, 1).cast("int")
    lists = [F.transform(F.sequence(F.lit(0), n % k), lambda i: i.cast("string")).alias(name) for k, name in ((2, "consensusPoints"), (3, "areasOfDebate"), (4, "noteworthyInsights"), (5, "keyQuotations"))]
    return counts.withColumn("sections", F.struct(F.concat(F.lit("About "), "theme_code").alias("executiveSummary"), *lists))


SUMMARISED = "s AS (SELECT theme_code AS code, count(*) AS comment_count, length(theme_code) + cast(right(theme_code, 1) AS int) AS n FROM fx_extracts GROUP BY 1)"


@query(f"WITH {SUMMARISED} SELECT code, comment_count FROM s JOIN fx_themes USING (code) WHERE contains(lower(concat('about ', code)), 'about 2') OR contains(lower(description), 'about 2')")
def summary_search(v: Views) -> DataFrame:
    return explore.summary_search(explore.with_summaries(_labelled(v), _summaries(v)), "about 2").select("code", "comment_count")


def _placed(ordered: DataFrame, *columns: str) -> DataFrame:
    """The order of a sorted table as a column ``position`` from 1."""
    return ordered.coalesce(1).select(*columns, (F.monotonically_increasing_id() + 1).cast("int").alias("position"))


@query(f"WITH {SUMMARISED}, j AS (SELECT s.* FROM s JOIN fx_themes USING (code)) SELECT 'theme' AS sorted, code, row_number() OVER (ORDER BY code)::integer AS position FROM j UNION ALL SELECT 'comments', code, row_number() OVER (ORDER BY comment_count DESC, code)::integer FROM j UNION ALL SELECT 'consensus', code, row_number() OVER (ORDER BY n % 2 DESC, code)::integer FROM j UNION ALL SELECT 'debate', code, row_number() OVER (ORDER BY n % 3 DESC, code)::integer FROM j UNION ALL SELECT 'insights', code, row_number() OVER (ORDER BY n % 4 DESC, code)::integer FROM j UNION ALL SELECT 'quotes', code, row_number() OVER (ORDER BY n % 5 DESC, code)::integer FROM j")
def summary_orders(v: Views) -> DataFrame:
    rows = explore.with_summaries(_labelled(v), _summaries(v))
    out = None
    for by in ("theme", "comments", *explore.SUMMARY_LISTS):
        one = _placed(explore.sort_summaries(rows, by), "code").withColumn("sorted", F.lit(by))
        out = one if out is None else out.unionByName(one)
    return out.select("sorted", "code", "position")


@query("SELECT m.comment_id AS id, CASE WHEN NOT m.is_representative AND r.o_orderpriority <> '5-LOW' THEN r.o_orderpriority ELSE nullif(o.o_orderpriority, '5-LOW') END AS shown FROM fx_membership m JOIN orders o ON o.o_orderkey = m.comment_id JOIN fx_clusters c ON c.cluster_id = m.cluster_id JOIN orders r ON r.o_orderkey = c.representative_comment_id")
def displayed_sections(v: Views) -> DataFrame:
    own = v.table("orders").select(F.col("o_orderkey").alias("comment_id"), F.when(F.col("o_orderpriority") != "5-LOW", F.create_map(F.lit("p"), F.col("o_orderpriority"))).alias("sections"))
    rows = v.membership().join(v.clusters().select("cluster_id", F.col("representative_comment_id").alias("representative_id")), "cluster_id").join(own, "comment_id")
    out = explore.displayed_sections(rows.select(F.col("comment_id").alias("id"), "sections", "is_representative", "representative_id"))
    return out.select("id", F.element_at("displayed", F.lit("p")).alias("shown"))


@query("SELECT id, concat_ws(',', CASE WHEN ord % 4 = 1 THEN '1' END, CASE WHEN ord % 3 = 1 THEN '2.1' END) AS themes FROM fx_comments")
def direct_themes(v: Views) -> DataFrame:
    scores = F.create_map(F.lit("2.1"), (F.col("ord") % 3).cast("int"), F.lit("1"), (F.col("ord") % 4).cast("int"))
    return v.comments().select("id", F.array_join(explore.direct_themes(scores), ",").alias("themes"))


@query("SELECT code FROM fx_themes WHERE code = '2' OR code LIKE '2.%'")
def theme_subtree(v: Views) -> DataFrame:
    return explore.subtree(v.themes(), "2").select("code")


@query("SELECT code FROM fx_themes WHERE level <= 1")
def themes_up_to_level(v: Views) -> DataFrame:
    return explore.up_to_level(v.themes(), 1).select("code")


@query("SELECT code, row_number() OVER (ORDER BY cast(split_part(code, '.', 1) AS int), cast(coalesce(nullif(split_part(code, '.', 2), ''), '0') AS int)) AS position, concat(repeat('  ', level - 1), code, '. ', description) AS line FROM fx_themes")
def theme_outline_order(v: Views) -> DataFrame:
    return explore.outline(v.themes()).select("code", "position", "line")


def _entities(v: Views) -> DataFrame:
    return v.comment_entities().groupBy("category", F.col("entity_label").alias("label")).agg(F.count("*").alias("mention_count"))


ENTITIES = "e AS (SELECT category, entity_label AS label, count(*) AS n FROM fx_comment_entities GROUP BY 1, 2)"


@query(f"WITH {ENTITIES} SELECT 'category' AS sorted, category, label, row_number() OVER (ORDER BY category, n DESC, label)::integer AS position FROM e UNION ALL SELECT 'alpha-asc', category, label, row_number() OVER (ORDER BY label, category)::integer FROM e UNION ALL SELECT 'alpha-desc', category, label, row_number() OVER (ORDER BY label DESC, category)::integer FROM e UNION ALL SELECT 'mentions-asc', category, label, row_number() OVER (ORDER BY n, category, label)::integer FROM e UNION ALL SELECT 'mentions-desc', category, label, row_number() OVER (ORDER BY n DESC, category, label)::integer FROM e")
def entity_orders(v: Views) -> DataFrame:
    out = None
    for by in ("category", "alpha-asc", "alpha-desc", "mentions-asc", "mentions-desc"):
        one = _placed(explore.sort_entities(_entities(v), by), "category", "label").withColumn("sorted", F.lit(by))
        out = one if out is None else out.unionByName(one)
    return out.select("sorted", "category", "label", "position")


@query("SELECT theme_code, array_to_string(list_slice(ids, 1, 3), ',') AS shown, cast(greatest(len(ids) - 3, 0) AS int) AS more FROM (SELECT theme_code, list_sort(list(DISTINCT comment_id)) AS ids FROM fx_extracts GROUP BY 1)")
def first_ids(v: Views) -> DataFrame:
    per = v.extracts().groupBy("theme_code").agg(F.array_sort(F.collect_set("comment_id")).alias("ids"))
    return per.select("theme_code", t.head_of(F.col("ids"), 3).alias("h")).select("theme_code", F.array_join("h.shown", ",").alias("shown"), "h.more")


@query("SELECT theme_code, x.comment_id, least(cluster_size, 3) AS score, o_orderpriority AS sections FROM fx_extracts x JOIN orders ON o_orderkey = x.comment_id WHERE cluster_size < 3")
def scored_comments(v: Views) -> DataFrame:
    scores = v.extracts().select("theme_code", "comment_id", F.least("cluster_size", F.lit(3)).alias("score"))
    condensed = v.table("orders").select(F.col("o_orderkey").alias("comment_id"), F.col("o_orderpriority").alias("structured_sections"))
    return explore.scored_comments(scores, condensed, most=2).select("theme_code", "comment_id", "score", F.col("structured_sections").alias("sections"))


@query("SELECT cast(sum(n) AS bigint) AS direct_count FROM (SELECT theme_code, sum(cluster_size) AS n FROM fx_extracts GROUP BY 1)")
def total_direct_mentions(v: Views) -> DataFrame:
    return explore.total_of(v.extracts().groupBy("theme_code").agg(F.sum("cluster_size").alias("direct_count")), "direct_count")


@query("SELECT cast(sum(len(regexp_extract_all(coalesce(comment, ''), '[^ \\t\\n\\x0B\\f\\r\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]+'))) AS bigint) AS word_count FROM fx_comments")
def word_totals(v: Views) -> DataFrame:
    return explore.total_of(v.comments().select(t.word_count(F.col("comment")).cast("long").alias("word_count")), "word_count")


@query("SELECT cast(sum(n) AS bigint) AS comments, cast(sum(k) AS bigint) AS themes FROM (SELECT source, count(*) AS n, count(DISTINCT lang) AS k FROM documents GROUP BY 1)")
def cross_collection_totals(v: Views) -> DataFrame:
    per = v.table("documents").groupBy("source").agg(F.count("*").alias("comments"), F.countDistinct("lang").alias("themes"))
    return explore.total_of(per, "comments", "themes")


@query("SELECT count(*) AS types FROM (SELECT coalesce(nullif(category, ''), 'Unknown') AS t FROM fx_comments GROUP BY 1 HAVING count(*) >= 5)")
def type_count(v: Views) -> DataFrame:
    return explore.type_count(v.comments().withColumnRenamed("category", "submitter_type"))


@query("SELECT x.comment_id AS id, o_orderpriority AS priority, x.position FROM (SELECT unnest(ids) AS comment_id, generate_subscripts(ids, 1)::integer - 1 AS position FROM (SELECT list_sort(list(DISTINCT comment_id)) AS ids FROM fx_extracts WHERE theme_code = '1.1')) x JOIN orders ON o_orderkey = x.comment_id")
def comments_of_theme(v: Views) -> DataFrame:
    from dockmill.operators.collection import inverted_index

    index = inverted_index(v.extracts(), ["theme_code"], "comment_id")
    comments = v.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    return explore.comments_for(index, comments, F.col("theme_code") == "1.1", "comment_ids")


@query("""SELECT m.id, concat_ws(chr(10), concat('<comment id="', m.id, '" metadata="', concat_ws(' | ', submitter, submitter_type, date, location), '">'),
concat_ws(chr(10) || chr(10), concat('**Summary:** ', one_line), concat('**Core Position:**', chr(10), core_position), concat('**Key Recommendations:**', chr(10)) || recommendations, concat('**Main Concerns:**', chr(10)) || concerns,
concat('### Theme-Specific Analysis', chr(10), '**Positions:**', chr(10), '- p', m.ord), CASE WHEN m.ord % 4 = 1 THEN '**Themes:** 1' END, CASE WHEN m.ord % 7 = 0 THEN '**Topics:** x (Place)' END), '</comment>') AS markdown FROM fx_meta m JOIN fx_sections s ON s.comment_id = m.id""")
def exported_comments(v: Views) -> DataFrame:
    from dockmill.operators.enrich import metadata

    rows = v.submissions().select("id", "ord", metadata(F.col("attributes_json")).alias("m")).join(v.sections().select(F.col("comment_id").alias("id"), F.col("structured_sections").alias("sections")), "id")
    none = F.array().cast("array<struct<category:string,label:string>>")
    rows = rows.select(
        "id",
        "m.submitter",
        "m.submitter_type",
        "m.date",
        "m.location",
        "sections",
        F.create_map(F.lit("positions"), F.array(F.concat(F.lit("p"), F.col("ord").cast("string")))).alias("extract"),
        F.create_map(F.lit("1"), (F.col("ord") % 4).cast("int")).alias("theme_scores"),
        F.when(F.col("ord") % 7 == 0, F.array(F.struct(F.lit("Place").alias("category"), F.lit("x").alias("label")))).otherwise(none).alias("entities"),
    )
    toggles = explore.comment_toggles(keyRecommendations=True, mainConcerns=True)
    return rows.select("id", explore.exported_comment(toggles).alias("markdown"))


@query("""SELECT id, concat_ws(chr(10), concat('<comment id="', id, '">'), 'No content available', '</comment>') AS markdown FROM fx_comments""")
def exported_nothing(v: Views) -> DataFrame:
    """All sections off."""
    off = explore.comment_toggles(**dict.fromkeys(explore.comment_toggles(), False))
    return v.comments().select("id", explore.exported_comment(off).alias("markdown"))


@query("/*recursive*/ WITH t AS (SELECT code, parent_code, coalesce(n, 0) AS n FROM fx_themes LEFT JOIN (SELECT theme_code, sum(cluster_size) AS n FROM fx_extracts GROUP BY 1) ON code = theme_code), r AS (SELECT code AS top, code, n FROM t UNION ALL SELECT r.top, t.code, t.n FROM r JOIN t ON t.parent_code = r.code) SELECT top AS code, cast(sum(n) AS bigint) AS subtree_count, count(*) AS themes FROM r GROUP BY 1")
def theme_subtree_counts(v: Views) -> DataFrame:
    """Weighted comments and themes below each theme, itself included."""
    counted = collection.theme_counts(v.themes(), v.extracts()).select("code", "parent_code", "comment_count")
    labels = hierarchy.labelled(counted, "code", "parent_code")
    return hierarchy.rollup(labels, subtree_count=F.col("comment_count"), themes=F.lit(1)).select("code", F.col("subtree_count").cast("long").alias("subtree_count"), F.col("themes").cast("long").alias("themes"))


@query("/*recursive*/ WITH t AS (SELECT ord, CASE WHEN ord > 0 THEN (ord - 1) // 3 END AS up, length(category) AS w FROM fx_comments), r AS (SELECT ord AS top, ord, w FROM t UNION ALL SELECT r.top, t.ord, t.w FROM r JOIN t ON t.up = r.ord) SELECT top AS ord, cast(sum(w) AS bigint) AS total, count(*) AS n FROM r GROUP BY 1")
def reply_tree_totals(v: Views) -> DataFrame:
    """A deep tree over all comments: totals of each subtree."""
    nodes = v.comments().select("ord", F.when(F.col("ord") > 0, F.floor((F.col("ord") - 1) / 3)).alias("up"), F.length("category").cast("long").alias("w"))
    return hierarchy.rollup(hierarchy.labelled(nodes, "ord", "up"), total=F.col("w"), n=F.lit(1)).select("ord", "total", F.col("n").cast("long").alias("n"))
