"""Queries over submissions: who says what, attachments, prompts, clusterings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.fixtures import Views
from dockmill.functions import text as t
from dockmill.operators import clusters, collection, enrich, similarity, stages
from dockmill.registry import query

# ---------------------------------------------------------------- submissions


@query("SELECT id, submitter, submitter_type, organization, location, date FROM fx_meta")
def submission_metadata(v: Views) -> DataFrame:
    return v.submissions().select("id", enrich.metadata(F.col("attributes_json")).alias("m")).select("id", "m.*")


@query("SELECT id, coalesce(nullif(concat_ws(chr(10), 'Submitter Name: ' || nullif(concat_ws(' ', first, last), ''), 'Organization: ' || organization, 'Category: ' || category), ''), 'No submitter metadata available') AS lines FROM fx_people")
def prompt_metadata_lines(v: Views) -> DataFrame:
    return v.submissions().select("id", enrich.prompt_lines(F.col("attributes_json")).alias("lines"))


@query("SELECT id, coalesce(organization, nullif(concat_ws(' ', first, last), ''), 'Anonymous') AS submitter, nullif(concat_ws(', ', city, state, country), '') AS location FROM fx_people")
def export_metadata(v: Views) -> DataFrame:
    at = lambda name: F.get_json_object("attributes_json", f"$.{name}").alias(name)
    rows = v.submissions().select("id", at("organization"), at("firstName"), at("lastName"), at("city"), at("stateProvinceRegion"), at("country"))
    return rows.select("id", t.submitter("organization", "firstName", "lastName").alias("submitter"), t.location("city", "stateProvinceRegion", "country", hide=None).alias("location"))


@query("SELECT id, content FROM fx_enriched")
def enriched_texts(v: Views) -> DataFrame:
    return enrich.enriched(v.submissions(), v.files()).select("id", "content")


@query("SELECT id, trim(split_part(content, '=== COMMENT TEXT ===', 2), E' \\t\\n\\x0B\\f\\r') AS text FROM fx_enriched")
def clustering_texts(v: Views) -> DataFrame:
    return enrich.enriched(v.submissions(), v.files()).select("id", enrich.clustering_text(F.col("content")).alias("text"))


@query("SELECT m.id, concat_ws(chr(10), concat('[', submitter_type, '] ', submitter), 'Organization: ' || m.organization, 'Location: ' || location, '', CASE WHEN m.ord % 3 = 0 THEN nullif(c.comment, '') END) AS content FROM fx_meta m JOIN fx_sections s ON s.comment_id = m.id JOIN fx_comments c ON c.id = m.id WHERE s.status = 'completed'")
def condensed_for_entities(v: Views) -> DataFrame:
    texts = v.comments().where("ord % 3 = 0").select(F.col("id").alias("comment_id"), F.col("comment").alias("markdown"), F.lit("completed").alias("status"))
    return enrich.condensed_for_entities(v.submissions(), v.sections(), texts).select("id", "content")


@query("SELECT id, count(comment_id) AS n_files, any_value(total) AS total FROM fx_comments LEFT JOIN fx_files ON id = comment_id CROSS JOIN (SELECT count(*) AS total FROM fx_comments) GROUP BY id")
def loaded_comments(v: Views) -> DataFrame:
    files = v.files().withColumn("id", F.concat_ws("-", "comment_id", F.col("ord").cast("string")))
    rows, total = collection.load_comments(v.comments(), files)
    return rows.crossJoin(total).select("id", F.coalesce(F.size("attachments"), F.lit(0)).cast("long").alias("n_files"), "total")  # one row on the right


@query("""SELECT comment_id, concat_ws(chr(10), concat('<comment id="', comment_id, '">'), concat('<core_position>', chr(10), core_position, chr(10), '</core_position>'), concat('<key_recommendations>', chr(10)) || recommendations || concat(chr(10), '</key_recommendations>'), concat('<main_concerns>', chr(10)) || concerns || concat(chr(10), '</main_concerns>'), '</comment>') AS block FROM fx_sections""")
def prompt_blocks(v: Views) -> DataFrame:
    return v.sections().select("comment_id", enrich.sections_block(F.col("comment_id"), F.col("structured_sections"), stages.SECTION_TAGS).alias("block"))


@query("""SELECT comment_id, concat('<comment id="', comment_id, '">', chr(10), CASE WHEN cluster_size >= 100 THEN concat('[FORM LETTER - ', cluster_size, ' identical submissions]') WHEN cluster_size >= 10 THEN concat('[CLUSTER - ', cluster_size, ' similar submissions]') WHEN cluster_size > 1 THEN concat('[SMALL CLUSTER - ', cluster_size, ' similar comments]') ELSE '[INDIVIDUAL]' END, chr(10), '<commenter_profile>', chr(10), 'No profile information provided', chr(10), '</commenter_profile>', chr(10), chr(10), '<theme_specific_content relevance="1">', chr(10), CASE WHEN comment_id % 2 = 0 THEN concat('**Positions:**', chr(10), '- a', chr(10), '- ', comment_id) ELSE 'No specific content extracted for this theme' END, chr(10), '</theme_specific_content>', chr(10), '</comment>') AS block FROM fx_membership""")
def extract_blocks(v: Views) -> DataFrame:
    lists = F.when(F.col("comment_id") % 2 == 0, F.create_map(F.lit("positions"), F.array(F.lit("a"), F.col("comment_id").cast("string")), F.lit("concerns"), F.array().cast("array<string>")))
    return v.membership().select("comment_id", enrich.extract_block(F.col("comment_id"), lists, F.lit(1), F.lit(""), F.col("cluster_size")).alias("block"))


@query("SELECT cast(split_part(code, '.', 1) AS int) AS top, string_agg(concat(code, ': ', description, '. ', coalesce(CASE WHEN level = 2 THEN 'g' END, '')), chr(10) ORDER BY level, cast(nullif(split_part(code, '.', 2), '') AS int)) AS text FROM fx_themes GROUP BY 1")
def theme_group_texts(v: Views) -> DataFrame:
    return stages.theme_groups(v.themes().withColumn("detailed_guidelines", F.when(F.col("level") == 2, "g")))


@query(r"WITH x AS (SELECT ord, CASE WHEN ord % 2 = 0 THEN 'Harm to the U.S' ELSE comment END AS d, CASE WHEN ord % 3 = 0 THEN concat('Better ', ord, '. ', category) ELSE 'no sentence' END AS g FROM fx_comments) SELECT ord, CASE WHEN regexp_matches(d, ' (U\.S|U\.K|vs|Dr|Mr|Mrs|Ms|Inc|Ltd|Corp)$', 'i') OR (length(d) < 50 AND NOT contains(d, '.')) THEN CASE WHEN ord % 3 = 0 THEN concat('Better ', ord) ELSE d END ELSE d END AS description FROM x")
def patched_descriptions(v: Views) -> DataFrame:
    rows = v.comments().select("ord", F.when(F.col("ord") % 2 == 0, "Harm to the U.S").otherwise(F.col("comment")).alias("d"), F.when(F.col("ord") % 3 == 0, F.concat(F.lit("Better "), F.col("ord").cast("string"), F.lit(". "), F.col("category"))).otherwise("no sentence").alias("g"))
    return rows.select("ord", t.patched_description(F.col("d"), F.col("g")).alias("description"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN json_extract_string(props, '$.k') END AS k, CASE WHEN event_id % 3 < 2 THEN 1 ELSE 0 END AS valid FROM events")
def unwrapped_extracts(v: Views) -> DataFrame:
    """Extracts in a wrapper, plain ones, and what is no JSON."""
    e = v.table("events")
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"relevance":1,"extract":{"x":'), F.to_json(F.array("props")), F.lit("}}"))).when(F.col("event_id") % 3 == 1, F.col("props")).otherwise("{broken")
    out = e.select("event_id", t.unwrapped_extract(raw).alias("x"), F.when(t.valid_json(raw).isNotNull(), 1).otherwise(0).alias("valid"))
    return out.select("event_id", F.coalesce(F.get_json_object("x", "$.x[0]"), F.get_json_object("x", "$.k")).alias("k"), "valid")


# ---------------------------------------------------------------- clusterings


GROUPED = "g AS (SELECT comment_id, o_totalprice, CASE WHEN cluster_size >= 12 THEN min(comment_id) OVER (PARTITION BY cluster_id) ELSE comment_id END AS g FROM fx_membership JOIN orders ON o_orderkey = comment_id)"


def _order_clusters(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders of a customer as a cluster led by the first; the dearest is taken for the longest."""
    first = F.min("o_orderkey").over(Window.partitionBy("o_custkey"))
    rows = v.table("orders").select(F.col("o_orderkey").alias("k"), first.alias("leader"), "o_totalprice")
    return clusters.clustering(rows, F.col("o_totalprice"), 12, 0.8)


@query(f"WITH {GROUPED}, r AS (SELECT g, dense_rank() OVER (ORDER BY g) AS cluster_id, arg_min(comment_id, (-o_totalprice, comment_id)) AS rep, count(*) AS cluster_size FROM g GROUP BY g) SELECT comment_id, cluster_id, comment_id = rep AS is_representative, cluster_size FROM g JOIN r USING (g)")
def stored_clusters(v: Views) -> DataFrame:
    """Small clusters taken apart, the rest numbered, with their longest member as representative."""
    full, members, _ = _order_clusters(v)
    return members.join(full.select("cluster_id", "cluster_size"), "cluster_id").select("comment_id", "cluster_id", "is_representative", "cluster_size")


@query(f"WITH {GROUPED}, n AS (SELECT count(*) AS n FROM g GROUP BY g) SELECT cast(sum(n) AS bigint) AS total_comments, count(*) AS total_clusters, count(*) AS representative_count, cast(sum(n) - count(*) AS bigint) AS duplicates_filtered, 12 AS min_cluster_size, 'completed' AS status FROM n")
def clustering_status(v: Views) -> DataFrame:
    return _order_clusters(v)[2].select("total_comments", "total_clusters", "representative_count", "duplicates_filtered", "min_cluster_size", "status")


@query("SELECT r.total_comments, r.total_clusters, l.largest_cluster_size FROM (SELECT * FROM fx_runs WHERE status = 'completed' ORDER BY created_at DESC LIMIT 1) r, (SELECT max(cluster_size) AS largest_cluster_size FROM fx_clusters) l")
def latest_clustering(v: Views) -> DataFrame:
    return clusters.latest_run(v.runs(), v.clusters()).select("total_comments", "total_clusters", "largest_cluster_size")


@query("SELECT comment_id FROM fx_membership WHERE is_representative")
def representative_ids(v: Views) -> DataFrame:
    return clusters.representative_ids(v.runs(), v.membership())


@query("SELECT l_orderkey AS id, coalesce(any_value(cluster_size), 1) AS cluster_size FROM (SELECT l_orderkey FROM lineitem UNION SELECT -l_orderkey FROM lineitem) LEFT JOIN fx_membership ON l_orderkey = comment_id GROUP BY 1")
def cluster_size_of(v: Views) -> DataFrame:
    keys = v.table("lineitem").select(F.col("l_orderkey").alias("id"))
    return clusters.sizes_of(keys.unionAll(keys.select(-F.col("id"))).distinct(), v.membership(), v.clusters())


@query("SELECT o_orderkey AS id FROM orders JOIN fx_membership ON o_orderkey = comment_id WHERE is_representative")
def representative_comments(v: Views) -> DataFrame:
    return clusters.representing(v.table("orders").select(F.col("o_orderkey").alias("id")), v.membership()).select("id")


@query("SELECT n AS size, count(*) AS clusters, count(*) * n AS comments FROM (SELECT count(*) AS n FROM fx_membership GROUP BY cluster_id) GROUP BY 1 ORDER BY 1 DESC LIMIT 5")
def cluster_top_sizes(v: Views) -> DataFrame:
    return clusters.top_sizes(v.membership())


@query("SELECT count(*) FILTER (is_representative) > 0 AS has_clustering, count(*) FILTER (is_representative) AS distinct_comments, count(*) AS total_comments FROM fx_membership")
def clustering_summary(v: Views) -> DataFrame:
    return clusters.summary(v.membership())


@query("SELECT m.comment_id, o.o_orderpriority AS sections, m.cluster_size, CASE WHEN m.comment_id % 2 = 0 THEN o.o_orderstatus END AS markdown FROM fx_membership m JOIN orders o ON o_orderkey = comment_id WHERE is_representative AND o_orderpriority <> '1-URGENT' AND NOT EXISTS (SELECT 1 FROM fx_extracts x WHERE x.comment_id = m.comment_id AND x.theme_code LIKE '1.%')")
def extract_queue(v: Views) -> DataFrame:
    orders = v.table("orders").select(F.col("o_orderkey").alias("comment_id"), F.col("o_orderpriority").alias("structured_sections"), F.when(F.col("o_orderpriority") == "1-URGENT", "failed").otherwise("completed").alias("status"), "o_orderstatus")
    texts = orders.where("comment_id % 2 = 0").select("comment_id", F.col("o_orderstatus").alias("markdown"), F.lit("completed").alias("status"))
    done = v.extracts().where(F.col("theme_code").startswith("1."))
    out = clusters.to_extract(orders, v.membership(), v.clusters(), texts, done)
    return out.select("comment_id", F.col("structured_sections").alias("sections"), "cluster_size", "markdown")


@query("SELECT comment_id, CASE WHEN is_representative AND cluster_size > 1 THEN CASE WHEN cluster_size > 100 THEN concat(cluster_size, ' aligned') ELSE concat('+', cluster_size - 1, ' similar') END END AS badge FROM fx_membership")
def cluster_badges(v: Views) -> DataFrame:
    return v.membership().select("comment_id", clusters.badge(F.col("cluster_size"), F.col("is_representative")).alias("badge"))


@query("SELECT concat('Showing ', count(*) FILTER (is_representative), ' clusters representing ', count(*), ' comments') AS caption FROM fx_membership")
def result_caption(v: Views) -> DataFrame:
    return clusters.caption(v.membership().where("is_representative"), v.membership())


@query()
def first_match_clusters(v: Views) -> DataFrame:
    """Turns of each conversation, clustered by their words."""
    rows = v.table("conversations").select("conv_id", "turn", F.array_distinct(t.normal_words(F.col("text"), 2)).alias("w"), F.length("text").alias("n"))
    return clusters.first_match_clusters(rows, "conv_id", "turn", "w", "n", 0.3)


# ---------------------------------------------------------------- queues and lookups


@query("SELECT o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM fx_extracts WHERE comment_id = o_orderkey AND theme_code LIKE '2.%')")
def unprocessed_items(v: Views) -> DataFrame:
    items = v.table("orders").select(F.col("o_orderkey").alias("id"))
    return collection.unprocessed(items, v.extracts().where(F.col("theme_code").startswith("2.")), "id")


@query("SELECT o_orderkey AS id, o_custkey AS attempt_count FROM orders JOIN fx_membership ON comment_id = o_orderkey WHERE is_representative AND o_orderstatus = 'F'")
def retry_representatives(v: Views) -> DataFrame:
    orders = v.table("orders")
    status = orders.select(F.col("o_orderkey").alias("comment_id"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("completed").alias("status"), F.col("o_custkey").alias("attempt_count"))
    return collection.failed(orders.select(F.col("o_orderkey").alias("id")), status, "id", v.membership().where("is_representative").select("comment_id")).select("id", "attempt_count")


@query("SELECT l_orderkey AS id, l_linenumber AS ord, any_value(format) AS format FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'pdf' WHEN 'N' THEN 'docx' ELSE 'txt' END AS format, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END, l_linenumber, l_partkey) AS nr FROM lineitem WHERE l_quantity > 5) WHERE nr = 1 GROUP BY 1, 2")
def transcription_sources(v: Views) -> DataFrame:
    """Per order the line whose format is read best; lines of small quantity have no data."""
    kind = F.when(F.col("l_returnflag") == "A", "pdf").when(F.col("l_returnflag") == "N", "docx").otherwise("txt")
    rows = v.table("lineitem").select(F.col("l_orderkey").alias("id"), F.struct("l_linenumber", "l_partkey").alias("ord"), kind.alias("format"), F.when(F.col("l_quantity") > 5, F.lit(b"x")).alias("blob_data"))
    return collection.transcription_source(rows, ["pdf"]).select("id", F.col("ord.l_linenumber").alias("ord"), "format")


@query("SELECT cast(sum(event_id) AS bigint) AS prompt_tokens, cast(sum(event_id % 7) AS bigint) AS cached_tokens, cast(sum(event_id % 11) AS bigint) AS output_tokens, round(cast(sum(event_id) - sum(event_id % 7) AS double) * 0.5 / 1e6 + cast(sum(event_id % 7) AS double) * 0.05 / 1e6 + cast(sum(event_id % 11) AS double) * 3 / 1e6, 6) AS cost, round(100.0 * cast(sum(event_id % 7) AS double) / cast(sum(event_id) AS double), 1) AS cache_pct FROM events")
def token_usage(v: Views) -> DataFrame:
    rows = v.table("events").select(F.col("event_id").alias("prompt_tokens"), (F.col("event_id") % 7).alias("cached_tokens"), (F.col("event_id") % 11).alias("output_tokens"))
    return stages.usage(rows, (0.5, 0.05, 3.0)).withColumn("cost", F.round("cost", 6))


@query("SELECT max(posted) AS last_posted FROM fx_people")
def last_posted(v: Views) -> DataFrame:
    return collection.last_posted(v.submissions())


@query("SELECT ord, len(string_split(comment, '.')) + 2 - len(list_filter(string_split(comment, '.'), lambda s: NOT ((len(regexp_extract_all(lower(s), '[^ \\t\\n\\r]+')) < 20 AND list_contains(regexp_extract_all(lower(s), '[^ \\t\\n\\r]+'), 'no')) OR contains(lower(s), 'not mentioned') OR contains(lower(s), 'no content')))) AS removed FROM fx_comments")
def removed_items(v: Views) -> DataFrame:
    raw = F.create_map(F.lit("positions"), F.split("comment", r"\."), F.lit("concerns"), F.array(F.lit("No specific concerns"), F.lit("none, not mentioned")))
    return v.comments().select("ord", stages.removed_items(raw, t.clean_extract(raw)).cast("long").alias("removed"))


@query("WITH w AS (SELECT category, label, CASE WHEN length(label) % 2 = 0 THEN '' WHEN length(label) % 3 = 0 THEN 'given' END AS d FROM fx_taxonomy) SELECT category, label, CASE WHEN trim(coalesce(d, '')) = '' THEN concat('References to ', label) ELSE d END AS definition, concat('x,', 'y') AS others FROM w")
def entity_definitions(v: Views) -> DataFrame:
    from dockmill.operators.entities import other_terms, with_definitions

    given = F.when(F.length("label") % 2 == 0, "").when(F.length("label") % 3 == 0, "given")
    out = with_definitions(v.taxonomy().withColumn("definition", given))
    return out.withColumn("others", F.array_join(other_terms(F.array(F.lit("x"), F.col("label"), F.lit("y")), F.col("label")), ","))


@query("""SELECT ord, CASE WHEN length(substr(comment, 1, 200)) > 100 THEN concat(substr(comment, 1, 100), '...') ELSE substr(comment, 1, 200) END AS preview, CASE WHEN ord > 100 THEN 'very-high' WHEN ord > 50 THEN 'high' WHEN ord > 20 THEN 'medium' ELSE 'low' END AS badge, concat('https://x/', id) AS url, category IN ('Organization', 'Business', 'src1') AND category <> 'src1' AS is_org, concat('f', ord, '.PDF') AS base, CASE WHEN ord % 2 = 0 THEN 'pdf' ELSE 'bin' END AS ext, concat(category, '|', region) AS keys, CASE WHEN ord % 2 = 0 THEN category ELSE concat('"', category) END AS unquoted, ord % 100 AS pages, 'Jan 2, 2024' AS shown FROM fx_comments""")
def scalar_texts(v: Views) -> DataFrame:
    """Small text functions side by side."""
    path = F.concat(F.lit("http://x/a/f"), F.col("ord").cast("string"), F.lit(".PDF"))
    quoted = F.when(F.col("ord") % 2 == 0, F.concat(F.lit('"'), "category", F.lit('"'))).otherwise(F.concat(F.lit('"'), "category"))
    return v.comments().select(
        "ord",
        t.preview(F.col("comment")).alias("preview"),
        t.badge(F.col("ord")).alias("badge"),
        t.record_url("https://x/", F.col("id")).alias("url"),
        t.is_organization(F.col("category")).alias("is_org"),
        t.basename(path).alias("base"),
        t.extension(F.when(F.col("ord") % 2 == 0, path).otherwise(F.lit("http://x/none"))).alias("ext"),
        F.array_join(t.entity_keys(F.array(F.struct("category", F.col("region").alias("label")))), ",").alias("keys"),
        t.unquote(quoted).alias("unquoted"),
        t.leading_int(F.concat((F.col("ord") % 100).cast("string"), F.lit(" pages"))).cast("long").alias("pages"),
        t.nice_date(F.lit("2024-01-02T00:00:00Z")).alias("shown"),
    )


@query("SELECT a, b FROM (SELECT x.o_orderkey AS a, min(y.o_orderkey) AS b FROM orders x JOIN orders y ON x.o_custkey = y.o_custkey GROUP BY 1)")
def cluster_leaders(v: Views) -> DataFrame:
    """Orders that share their one feature follow the earliest."""
    sets = v.table("orders").select("o_orderkey", F.array(F.col("o_custkey").cast("string")).alias("f"))
    return similarity.leaders(sets, "o_orderkey", "f", 0.8).select(F.col("k").alias("a"), F.col("leader").alias("b"))


# ---------------------------------------------------------------- whole records


@query("""SELECT p.ord AS id, p.text IS NOT NULL AS there, coalesce(organization, nullif(concat_ws(' ', first, last), ''), 'Anonymous') AS submitter, coalesce(category, CASE WHEN organization IS NOT NULL THEN 'Organization' ELSE 'Individual' END) AS submitter_type, coalesce(posted, received) AS date, concat_ws(', ', city, state, country) AS location,
  CASE WHEN ord % 10 <> 0 THEN s.one_line END AS one_line, CASE WHEN ord % 3 = 0 THEN concat('full ', ord) END AS detailed, cast(CASE WHEN ord % 10 <> 0 THEN 4 ELSE 0 END + CASE WHEN ord % 3 = 0 THEN 1 ELSE 0 END AS bigint) AS n_sections,
  f.comment_id IS NOT NULL AS has_attachments, cast(CASE WHEN ord % 6 <> 0 THEN len(regexp_extract_all(s.one_line || ' ' || s.core_position || ' ' || ord, '[^ ]+')) ELSE 0 END AS bigint) AS word_count, coalesce(m.cluster_size, 1) AS cluster_size, coalesce(a.codes, b.codes, '') AS codes
  FROM fx_people p JOIN fx_sections s USING (ord) LEFT JOIN (SELECT DISTINCT comment_id FROM fx_files) f ON f.comment_id = p.id LEFT JOIN fx_membership m ON m.comment_id = p.ord LEFT JOIN (SELECT cluster_id, comment_id FROM fx_membership WHERE is_representative) r ON r.cluster_id = m.cluster_id
  LEFT JOIN (SELECT comment_id, string_agg(DISTINCT theme_code, ',' ORDER BY theme_code) AS codes FROM fx_extracts GROUP BY 1) a ON a.comment_id = p.ord LEFT JOIN (SELECT comment_id, string_agg(DISTINCT theme_code, ',' ORDER BY theme_code) AS codes FROM fx_extracts GROUP BY 1) b ON b.comment_id = r.comment_id""")
def export_records(v: Views) -> DataFrame:
    """The records of a browser's comment list; a transcription takes the place of the detailed content."""
    files = v.files().groupBy(F.col("comment_id").alias("__id")).agg(F.count("*").alias("attachment_count"))
    sections = v.sections().select("ord", "structured_sections", "status")
    o, words = F.col("ord"), F.concat_ws(" ", F.col("structured_sections")["oneLineSummary"], F.col("structured_sections")["corePosition"], F.col("ord").cast("string"))
    whole = v.submissions().join(sections, "ord").join(files, F.col("id") == F.col("__id"), "left")
    comments = whole.select(
        o.alias("id"), F.lit("D").alias("document_id"), "attributes_json", "attachment_count",
        F.when(o % 6 != 0, t.word_count(words)).alias("word_count"), F.when(F.col("status") == "completed", F.col("structured_sections")).alias("structured_sections"),
        F.when(o % 3 == 0, F.concat(F.lit("full "), o.cast("string"))).otherwise("").alias("transcription_markdown"),
    )
    out = collection.export_records(comments, v.extracts(), v.comment_entities(), v.membership())
    shown = F.col("structured_sections")
    return out.select(
        "id", (F.col("document_id") == "D").alias("there"), "submitter", "submitter_type", "date", "location", shown["oneLineSummary"].alias("one_line"), shown["detailedContent"].alias("detailed"),
        F.coalesce(F.nullif(F.size(shown), F.lit(-1)), F.lit(0)).cast("long").alias("n_sections"), "has_attachments", "word_count", "cluster_size", F.array_join(F.array_sort(F.map_keys("theme_scores")), ",").alias("codes"),
    )


@query("""WITH d AS (SELECT source, lang, doc_id, concat('2024-0', doc_id % 9 + 1, '-0', doc_id % 7 + 1) AS posted, cast(regexp_extract(source, '[0-9]+') AS bigint) AS nr FROM documents)
SELECT CASE WHEN nr % 3 = 0 THEN concat('docket ', source) ELSE source END AS id, CASE WHEN nr % 2 = 0 THEN concat('On ', source) ELSE source END AS title, CASE WHEN nr % 4 = 0 THEN 'Long name' WHEN nr % 4 = 2 THEN 'LN' ELSE 'Unknown Agency' END AS agency, count(*) AS comment_count, count(DISTINCT lang) AS theme_count, count(DISTINCT concat(lang, doc_id % 3)) AS entity_count, CASE WHEN nr % 6 = 0 THEN '2025-01-01' ELSE max(posted) END AS last_comment_date FROM d GROUP BY source, nr""")
def catalogue_rows(v: Views) -> DataFrame:
    """Collections by source with their counts, names and last dates; some have no metadata."""
    nr, day = F.regexp_extract("source", "[0-9]+", 0).cast("long"), F.concat(F.lit("2024-0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit("-0"), (F.col("doc_id") % 7 + 1).cast("string"))
    d = v.table("documents").select(F.col("source").alias("document_id"), "lang", "doc_id", nr.alias("nr"), F.to_json(F.struct(day.alias("postedDate"))).alias("attributes_json"))
    n = F.col("nr")
    known = d.select("document_id", "nr").distinct().where("nr % 2 = 0 or nr % 3 = 0").select(
        "document_id", F.when(n % 2 == 0, F.concat(F.lit("On "), "document_id")).otherwise("").alias("title"), F.when(n % 4 == 0, "Long name").alias("agency_name"), F.when(n % 2 == 0, "LN").otherwise("").alias("agency_id"),
        F.when(n % 6 == 0, "2025-01-01").alias("comment_end_date"), F.when(n % 3 == 0, F.concat(F.lit("docket "), "document_id")).alias("docket_id"),
    )
    entities = d.select("document_id", F.concat("lang", (F.col("doc_id") % 3).cast("string"))).distinct()
    return collection.catalogue_rows(d.select("document_id", "attributes_json"), known, d.select("document_id", "lang").distinct(), entities)


@query(r"SELECT ord, cast(len(regexp_extract_all(concat_ws(' ', array_to_string(string_split(comment, '.'), ' '), region, concat('who ', category)), '[^ \t\n\x0B\f\r\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+')) AS bigint) AS words FROM fx_comments")
def extract_word_counts(v: Views) -> DataFrame:
    """Words of extracts and of the commenter's profile."""
    extract = F.create_map(F.lit("positions"), F.split("comment", r"\."), F.lit("concerns"), F.array("region"))
    return v.comments().select("ord", stages.extract_words(extract, F.concat(F.lit("who "), "category")).cast("long").alias("words"))


@query("SELECT event_id, event_type IN ('click', 'signup') AS plain, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS is_org, strftime(ts, '%b %-d, %Y') AS shown FROM events")
def kinds_and_dates(v: Views) -> DataFrame:
    """Kinds of submitters that are organizations, and dates as they are shown."""
    kind = F.element_at(F.array(F.lit(t.ORGANIZATION_TYPES[0]), F.lit(t.ORGANIZATION_TYPES[-1]), F.lit("Individual"), F.lit(None).cast("string")), (F.col("event_id") % 4 + 1).cast("int"))
    return v.table("events").select("event_id", F.col("event_type").isin("click", "signup").alias("plain"), t.is_organization(kind).alias("is_org"), t.nice_date(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("shown"))
