"""Queries over the fixture views and their SQL oracles, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.fixtures import Views
from dockmill.functions import shingles
from dockmill.functions import text as t
from dockmill.operators import batching, collection, entities, explore, search_index, similarity
from dockmill.registry import ORACLES, QUERIES, query

WORDS = r"regexp_extract_all({0}, '[^\s]+')"
WC = "len(regexp_extract_all(coalesce({0}, ''), '[^ \\t\\n\\x0B\\f\\r\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{FEFF}}]+'))"


# ---------------------------------------------------------------- counts and joins


@query("SELECT code, description, level, parent_code, cast(coalesce(n, 0) AS bigint) AS comment_count FROM fx_themes LEFT JOIN (SELECT theme_code, coalesce(sum(cluster_size), count(DISTINCT comment_id)) AS n FROM fx_extracts GROUP BY 1) ON code = theme_code")
def theme_weighted_counts(v: Views) -> DataFrame:
    return collection.theme_counts(v.themes(), v.extracts()).select("code", "description", "level", "parent_code", "comment_count")


@query("SELECT theme_code, description, cast(coalesce(w, stored) AS bigint) AS comment_count FROM (SELECT code AS theme_code, description, 7 AS stored FROM fx_themes) LEFT JOIN (SELECT theme_code AS c, sum(cluster_size) AS w FROM fx_extracts GROUP BY 1) ON theme_code = c")
def theme_summary_counts(v: Views) -> DataFrame:
    summaries = v.themes().select(F.col("code").alias("theme_code"), F.lit(7).cast("long").alias("comment_count"))
    return collection.summary_counts(summaries, v.themes(), v.extracts()).select("theme_code", "description", "comment_count")


@query("SELECT theme_code, count(DISTINCT comment_id) AS comment_count FROM fx_extracts GROUP BY 1 HAVING count(DISTINCT comment_id) >= 2000")
def theme_having_min(v: Views) -> DataFrame:
    return collection.themes_with_at_least(v.extracts(), 2000)


@query("SELECT code, cast(coalesce(n, 0) AS bigint) AS comments FROM fx_themes LEFT JOIN (SELECT theme_code, count(DISTINCT comment_id) AS n FROM fx_extracts GROUP BY 1) ON code = theme_code ORDER BY 2 DESC, 1 LIMIT 10")
def coverage_top10(v: Views) -> DataFrame:
    return collection.coverage(v.themes(), v.extracts())


@query("SELECT t.category, t.label, cast(sum(coalesce(m.cluster_size, 1)) AS bigint) AS mention_count FROM fx_taxonomy t LEFT JOIN fx_comment_entities e ON t.category = e.category AND t.label = e.entity_label LEFT JOIN fx_membership m ON e.comment_id = m.comment_id GROUP BY 1, 2")
def entity_mention_weighted(v: Views) -> DataFrame:
    return collection.entity_weights(v.taxonomy(), v.comment_entities(), v.membership())


@query("SELECT t.category, t.label, cast(coalesce(n, 0) AS bigint) AS mention_count FROM fx_taxonomy t LEFT JOIN (SELECT category, entity_label, sum(s) AS n FROM (SELECT DISTINCT e.category, e.entity_label, coalesce(cast(m.cluster_id AS varchar), concat('d', e.comment_id)) AS k, coalesce(m.cluster_size, 1) AS s FROM fx_comment_entities e LEFT JOIN fx_membership m ON e.comment_id = m.comment_id) GROUP BY 1, 2) x ON t.category = x.category AND t.label = x.entity_label")
def entity_mention_distinct(v: Views) -> DataFrame:
    return collection.entity_weights(v.taxonomy(), v.comment_entities(), v.membership(), strict=False)


@query("""SELECT o.o_orderkey AS id, coalesce(m.cluster_size, 1) AS cluster_size, m.is_representative AS is_cluster_representative, r.comment_id AS cluster_representative_id,
  array_to_string(coalesce(a.codes, b.codes, []), ',') AS theme_codes, (a.codes IS NULL AND b.codes IS NOT NULL) AS is_aligned_summary, coalesce(n.n, 0) AS n_entities
  FROM orders o LEFT JOIN fx_membership m ON o.o_orderkey = m.comment_id LEFT JOIN (SELECT cluster_id, comment_id FROM fx_membership WHERE is_representative) r ON m.cluster_id = r.cluster_id
  LEFT JOIN (SELECT comment_id, list_sort(list_distinct(list(theme_code))) AS codes FROM fx_extracts GROUP BY 1) a ON a.comment_id = o.o_orderkey
  LEFT JOIN (SELECT comment_id, list_sort(list_distinct(list(theme_code))) AS codes FROM fx_extracts GROUP BY 1) b ON b.comment_id = r.comment_id
  LEFT JOIN (SELECT comment_id, count(*) AS n FROM fx_comment_entities GROUP BY 1) n ON n.comment_id = o.o_orderkey""")
def comments_export(v: Views) -> DataFrame:
    comments = v.table("orders").select(F.col("o_orderkey").alias("id"))
    out = collection.export_comments(comments, v.extracts(), v.comment_entities(), v.membership())
    return out.withColumn("theme_codes", F.array_join("theme_codes", ",")).withColumn("n_entities", F.size("entities").cast("long")).drop("entities")


@query("SELECT cluster_id, count(*) AS size, max(CASE WHEN is_representative THEN comment_id END) AS representative_id, string_agg(cast(comment_id AS varchar), ',' ORDER BY comment_id) AS members FROM fx_membership GROUP BY 1 HAVING count(*) >= 2")
def cluster_report(v: Views) -> DataFrame:
    return collection.cluster_report(v.membership()).withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), ","))


@query("SELECT n AS size, count(*) AS clusters FROM (SELECT count(*) AS n FROM fx_membership GROUP BY cluster_id) GROUP BY 1")
def cluster_size_hist(v: Views) -> DataFrame:
    return collection.cluster_sizes(v.membership())


@query("SELECT cast(sum(n) AS bigint) AS total, count(*) AS clusters, max(n) AS largest, cast(sum(n) - count(*) AS bigint) AS duplicates, cast(round(100.0 * (sum(n) - count(*)) / sum(n), 1) AS double) AS reduction_pct FROM (SELECT count(*) AS n FROM fx_membership GROUP BY cluster_id)")
def cluster_statistics(v: Views) -> DataFrame:
    return collection.cluster_statistics(v.membership())


@query("SELECT cast(sum(s) AS bigint) AS total_submissions FROM (SELECT DISTINCT cluster_id, cluster_size AS s FROM fx_membership)")
def collection_stats(v: Views) -> DataFrame:
    return collection.total_submissions(v.membership(), v.comments())


@query("SELECT task_type, task_level, count(*) AS entries, min(created_at) AS oldest, max(created_at) AS newest FROM fx_cache GROUP BY 1, 2")
def cache_stats(v: Views) -> DataFrame:
    return collection.cache_statistics(v.cache())


@query("SELECT cast(sum(length(prompt_hash) + length(task_type) + length(task_params)) AS bigint) AS characters FROM fx_cache WHERE result IS NOT NULL")
def cache_size(v: Views) -> DataFrame:
    return collection.cache_size(v.cache().withColumn("result", F.when(F.col("result").isNotNull(), "")))


@query("SELECT task_params, count(*) AS n FROM fx_cache GROUP BY 1 HAVING count(*) > 1")
def cache_duplicates(v: Views) -> DataFrame:
    return collection.duplicates(v.cache(), "task_params")


@query("SELECT event_id FROM fx_cache WHERE NOT (task_type = 'click' AND task_level = 1) AND created_at >= (SELECT min(created_at) + INTERVAL 2 DAY FROM fx_cache)")
def cache_expire(v: Views) -> DataFrame:
    cache = v.cache()
    since = cache.agg((F.min("created_at") + F.expr("INTERVAL 2 DAYS")).alias("since"))
    kept = collection.expire(cache.crossJoin(since), ((F.col("task_type") == "click") & (F.col("task_level") == 1)) | (F.col("created_at") < F.col("since")))
    return kept.select("event_id")


@query("SELECT theme_code, string_agg(DISTINCT cast(comment_id AS varchar), ',' ORDER BY cast(comment_id AS varchar)) AS ids FROM fx_extracts WHERE comment_id % 50 = 0 OR TRUE GROUP BY 1")
def theme_index(v: Views) -> DataFrame:
    out = collection.inverted_index(v.extracts().withColumn("comment_id", F.col("comment_id").cast("string")), ["theme_code"], "comment_id")
    return out.select("theme_code", F.array_join("comment_ids", ",").alias("ids"))


@query("SELECT concat(category, '|', entity_label) AS entity, string_agg(DISTINCT cast(comment_id AS varchar), ',' ORDER BY cast(comment_id AS varchar)) AS ids FROM fx_comment_entities GROUP BY 1")
def entity_index(v: Views) -> DataFrame:
    out = collection.inverted_index(v.comment_entities().withColumn("comment_id", F.col("comment_id").cast("string")), ["category", "entity_label"], "comment_id")
    return out.select(F.concat_ws("|", "category", "entity_label").alias("entity"), F.array_join("comment_ids", ",").alias("ids"))


@query("SELECT p.code, coalesce(string_agg(c.code, ',' ORDER BY c.code), '') AS children FROM fx_themes p LEFT JOIN fx_themes c ON c.parent_code = p.code GROUP BY 1")
def theme_children(v: Views) -> DataFrame:
    return collection.children(v.themes()).select("code", F.array_join("children", ",").alias("children"))


@query("/*recursive*/ WITH a AS (SELECT code, parent_code AS ancestor FROM fx_themes WHERE parent_code IS NOT NULL UNION ALL SELECT a.code, t.parent_code FROM a JOIN fx_themes t ON t.code = a.ancestor WHERE t.parent_code IS NOT NULL) SELECT code, ancestor, len(string_split(ancestor, '.'))::integer AS depth FROM a")
def theme_ancestors(v: Views) -> DataFrame:
    return collection.ancestors(v.themes())


@query("SELECT code, row_number() OVER (ORDER BY cast(string_split(code, '.')[1] AS int), coalesce(cast(string_split(code, '.')[2] AS int), 0))::integer AS position FROM fx_themes")
def natural_sort_codes(v: Views) -> DataFrame:
    from pyspark.sql.window import Window

    return v.themes().select("code", F.row_number().over(Window.orderBy(t.natural_key(F.col("code")))).alias("position"))  # themes of one collection


@query("SELECT code, concat(repeat('  ', level - 1), code, '. ', description) AS line FROM fx_themes")
def theme_outline(v: Views) -> DataFrame:
    return explore.outline(v.themes()).select("code", "line")


# ---------------------------------------------------------------- queues and stores


@query("SELECT id FROM fx_comments WHERE ord >= (SELECT count(*) FROM fx_status) ORDER BY ord LIMIT 100")
def load_resume_offset(v: Views) -> DataFrame:
    rows = v.comments().withColumn("ord", F.col("ord") + 1)
    return collection.after_offset(rows, v.status(), 100).select("id")


@query("SELECT id FROM fx_comments c WHERE NOT EXISTS (SELECT 1 FROM fx_status s WHERE s.comment_id = c.id) ORDER BY ord LIMIT (SELECT greatest(500 - count(*), 0) FROM fx_status)")
def new_only_antijoin(v: Views) -> DataFrame:
    return collection.only_new(v.comments(), v.status().withColumnRenamed("comment_id", "id"), "id", 500).select("id")


@query("SELECT id FROM fx_comments LEFT JOIN fx_status ON id = comment_id WHERE comment_id IS NULL OR status IN ('pending', 'processing')")
def work_queue_pending(v: Views) -> DataFrame:
    return collection.pending(v.comments(), v.status(), "id").select("id")


@query("SELECT id, attempt_count FROM fx_comments JOIN fx_status ON id = comment_id WHERE status = 'failed'")
def retry_failed_queue(v: Views) -> DataFrame:
    return collection.failed(v.comments(), v.status(), "id").select("id", "attempt_count")


@query("SELECT count(*) AS total, cast(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS bigint) AS completed, cast(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS bigint) AS failed, cast(sum(CASE WHEN status IN ('pending', 'processing') THEN 1 ELSE 0 END) AS bigint) AS pending FROM fx_status")
def status_summary(v: Views) -> DataFrame:
    return collection.status_summary(v.status())


@query("SELECT id, coalesce(nullif(CASE WHEN ord % 3 = 0 THEN comment ELSE '' END, ''), concat_ws(chr(10) || chr(10), category, region)) AS content FROM fx_comments JOIN fx_status ON id = comment_id WHERE status = 'completed'")
def condensed_content_join(v: Views) -> DataFrame:
    c = v.comments()
    sections = F.struct(F.col("category").alias("corePosition"), F.col("region").alias("keyRecommendations"), F.lit("").alias("mainConcerns"))
    condensed = v.status().join(c.select(F.col("id").alias("comment_id"), sections.alias("structured_sections")), "comment_id")
    transcriptions = c.select(F.col("id").alias("comment_id"), F.when(F.col("ord") % 3 == 0, F.col("comment")).otherwise("").alias("markdown"), F.lit("completed").alias("status"))
    return collection.condensed_content(c, condensed, transcriptions).select("id", "content")


@query("SELECT o_orderkey AS id, o_orderpriority AS priority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1 AS latest FROM orders QUALIFY latest")
def latest_wins_upsert(v: Views) -> DataFrame:
    rows = v.table("orders").select("o_custkey", F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.struct("o_orderdate", (-F.col("o_orderkey")).alias("k")).alias("version"))
    old, new = rows.where(F.col("id") % 2 == 0), rows.where(F.col("id") % 2 == 1)
    return collection.latest_wins(old, new, ["o_custkey"]).select("id", "priority", F.lit(True).alias("latest"))


@query("SELECT user_id AS comment_id, arg_max(event_type, (ts, event_id)) AS status, count(*) FILTER (WHERE event_type = 'error') AS attempt_count FROM events GROUP BY 1")
def status_fold(v: Views) -> DataFrame:
    log = v.table("events").select(F.col("user_id").alias("comment_id"), F.when(F.col("event_type") == "error", "failed").otherwise(F.col("event_type")).alias("status"), F.lit("x").alias("error_message"), F.struct("ts", "event_id").alias("version"))
    return collection.fold_status(log).select("comment_id", F.when(F.col("status") == "failed", "error").otherwise(F.col("status")).alias("status"), "attempt_count")


@query("SELECT DISTINCT e.comment_id, e.category, e.entity_label FROM fx_comment_entities e WHERE NOT EXISTS (SELECT 1 FROM fx_comment_entities s WHERE s.comment_id % 2 = 0 AND s.comment_id = e.comment_id AND s.category = e.category AND s.entity_label = e.entity_label)")
def insert_ignore(v: Views) -> DataFrame:
    e = v.comment_entities()
    return collection.insert_ignore(e.where("comment_id % 2 = 0"), e.unionAll(e), ["comment_id", "category", "entity_label"])


@query("""WITH e AS (SELECT event_id, sha256(concat('stub', chr(10), event_id)) AS prompt_hash FROM events)
SELECT event_id, prompt_hash, CASE WHEN event_id % 4 = 0 THEN concat('kept ', event_id) ELSE concat('{"relevance": 1, "digest": "', substr(sha256(cast(event_id AS varchar)), 1, 12), '"}') END AS result, event_id % 4 = 0 AS hit FROM e""")
def prompt_cache_join(v: Views) -> DataFrame:
    """Every event asks; the cache has a result for a fourth of them, twice for some, and blank ones for others."""
    from dockmill.operators.generate import generate

    events = v.table("events").select("event_id", F.col("event_id").cast("string").alias("prompt"), "ts")
    stored = events.where("event_id % 2 = 0").select("event_id", F.sha2(F.concat_ws("\n", F.lit("stub"), "prompt"), 256).alias("prompt_hash"), F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("kept "), "prompt")).otherwise("").alias("result"), F.col("ts").alias("created_at"))
    older = stored.where("event_id % 8 = 0").withColumns({"result": F.lit("old"), "created_at": F.col("created_at") - F.expr("INTERVAL 1 DAY")})
    blank = stored.where("event_id % 16 = 0").withColumns({"result": F.lit(None).cast("string"), "created_at": F.col("created_at") + F.expr("INTERVAL 1 DAY")})
    answered, fresh = generate(events, "prompt", "stub", stored.unionByName(older).unionByName(blank))
    made = fresh.select(F.col("prompt_hash").alias("__h"), F.lit(False).alias("__hit"))
    out = answered.join(made, F.col("prompt_hash") == F.col("__h"), "left")
    return out.select("event_id", "prompt_hash", "result", F.coalesce("__hit", F.lit(True)).alias("hit"))


@query("SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'Complete' WHEN count(*) FILTER (event_type = 'click') > 0 THEN 'Themes Scored' WHEN count(*) > 3 THEN 'Themes Discovered' WHEN count(*) > 1 THEN 'Condensed' ELSE 'Comments Loaded' END AS stage FROM events GROUP BY 1")
def stage_label(v: Views) -> DataFrame:
    per = v.table("events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("a"), F.count_if(F.col("event_type") == "click").alias("b"), F.count("*").alias("n"))
    return per.select("user_id", t.stage_label(F.col("a"), F.col("b"), F.when(F.col("n") > 3, 1).otherwise(0), F.when(F.col("n") > 1, 1).otherwise(0), F.col("n")).alias("stage"))


# ---------------------------------------------------------------- text


@query(f"SELECT id, {WC.format('comment')} AS words FROM fx_comments")
def word_counts(v: Views) -> DataFrame:
    return v.comments().select("id", t.word_count(F.col("comment")).cast("long").alias("words"))


FEATURES = r"""w AS (SELECT ord, list_filter(string_split_regex(lower(comment), '[^a-z0-9_]+'), lambda x: length(x) > 1) AS w FROM fx_comments),
f AS (SELECT DISTINCT ord, concat('n', k, ':', array_to_string(list_slice(w, i0, i0 + k - 1), ' ')) AS f FROM w, (SELECT unnest([3, 4, 5]) AS k), LATERAL (SELECT unnest(range(1, greatest(len(w) - k + 2, 1))) AS i0))"""


@query(f"WITH {FEATURES}, n AS (SELECT ord, count(*) AS n FROM f GROUP BY 1) SELECT c.ord, coalesce(n, 0) AS n FROM fx_comments c LEFT JOIN n ON n.ord = c.ord")
def ngram_features(v: Views) -> DataFrame:
    return v.comments().select("ord", F.size(shingles.feature_ids(F.col("comment"))).cast("long").alias("n"))


@query(f"WITH {FEATURES}, m AS (SELECT ord, f FROM f UNION SELECT ord, concat('w:', unnest(w)) FROM w), n AS (SELECT ord, count(*) AS n, count(*) FILTER (f LIKE 'w:%') AS words FROM m WHERE f NOT LIKE 'w:%' OR length(f) > 4 GROUP BY 1) SELECT c.ord, coalesce(n, 0) AS n, coalesce(words, 0) AS words FROM fx_comments c LEFT JOIN n ON n.ord = c.ord")
def both_features(v: Views) -> DataFrame:
    return v.comments().select("ord", shingles.feature_counts(F.col("comment")).alias("f")).select("ord", "f.n", "f.words")


PAIRS = f"""{FEATURES}, n AS (SELECT ord, count(*) AS n FROM f GROUP BY 1),
p AS (SELECT x.ord AS a, y.ord AS b, count(*) AS c FROM f x JOIN f y ON x.f = y.f AND x.ord < y.ord GROUP BY 1, 2),
e AS (SELECT a, b, c / (na.n + nb.n - c) AS similarity FROM p JOIN n na ON na.ord = a JOIN n nb ON nb.ord = b WHERE c / (na.n + nb.n - c) >= 0.8)"""


@query(f"WITH {PAIRS} SELECT a, b, round(similarity, 6) AS similarity FROM e")
def jaccard_pairs(v: Views) -> DataFrame:
    sets = v.comments().select("ord", shingles.feature_ids(F.col("comment")).alias("features"))
    return similarity.similar_pairs(sets, "ord", "features", 0.8).withColumn("similarity", F.round("similarity", 6))


@query()
def leader_clusters(v: Views) -> DataFrame:
    sets = v.comments().select("ord", shingles.feature_ids(F.col("comment")).alias("features"))
    return similarity.leaders(sets, "ord", "features", 0.8)


@query("WITH c AS (SELECT comment_id AS k, cluster_id AS leader, count(*) OVER (PARTITION BY cluster_id) AS n FROM fx_membership) SELECT k, CASE WHEN n >= 12 THEN leader ELSE k END AS leader FROM c")
def disaggregate(v: Views) -> DataFrame:
    return similarity.disaggregate(v.membership().select(F.col("comment_id").alias("k"), F.col("cluster_id").alias("leader")), 12)


@query("WITH c AS (SELECT ord AS k, category AS leader, length(comment) AS n FROM fx_comments) SELECT leader, arg_max(k, (n, -k)) AS representative, count(*) AS cluster_size FROM c GROUP BY 1")
def representative_longest(v: Views) -> DataFrame:
    c = v.comments().select(F.col("ord").alias("k"), F.col("category").alias("leader"), F.length("comment").alias("n"))
    return similarity.representatives(c, F.col("n"), F.col("k"))


@query(r"SELECT page_id, nr, part FROM (SELECT page_id, unnest(p) AS part, generate_subscripts(p, 1)::integer AS nr FROM (SELECT page_id, list_filter(string_split_regex(concat_ws(';', url, concat('http://x/', page_id, '.pdf')), '[\s;,|]+'), lambda x: x <> '') AS p FROM pages))")
def attachment_url_explode(v: Views) -> DataFrame:
    from dockmill.sources.bulk import attachment_urls

    rows = v.table("pages").select("page_id", F.posexplode(attachment_urls(F.col("url"), F.concat(F.lit("http://x/"), F.col("page_id").cast("string"), F.lit(".pdf")))).alias("nr", "part"))
    return rows.select("page_id", (F.col("nr") + 1).alias("nr"), "part")


@query("SELECT l_orderkey AS id, arg_max(l_returnflag, (CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 ELSE 0 END, -l_linenumber)) AS format FROM lineitem GROUP BY 1")
def best_format_argmax(v: Views) -> DataFrame:
    rows = v.table("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("format"), F.col("l_linenumber").alias("ord"))
    return collection.best_attachment(rows, ["A", "N", "R"]).select("id", "format")


@query("SELECT ord, CASE WHEN ord % 4 = 0 THEN NULL ELSE category END AS core_position, comment AS main_concerns, CASE WHEN ord % 4 = 0 THEN 6 ELSE 5 END AS n_missing FROM (SELECT ord, category, rtrim(ltrim(replace(comment, '#', ''), E' \\t\\n\\r'), E' \\t\\n\\r') AS comment FROM fx_comments)")
def section_parser(v: Views) -> DataFrame:
    body = F.concat(F.lit("### CORE POSITION \nold\n"), F.when(F.col("ord") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("### Core Position\n"), "category", F.lit("\n"))), F.lit("### main concerns\n"), F.replace("comment", F.lit("#"), F.lit("")))
    body = F.when(F.col("ord") % 4 == 0, F.replace(body, F.lit("### CORE POSITION \nold\n"), F.lit("### UNKNOWN\nold\n"))).otherwise(body)
    found = v.comments().select("ord", t.sections(body).alias("s"))
    return found.select("ord", F.element_at("s", F.lit("corePosition")).alias("core_position"), F.element_at("s", F.lit("mainConcerns")).alias("main_concerns"), F.size(t.missing_sections(F.col("s"))).alias("n_missing"))


@query("SELECT event_id, props AS body FROM events")
def fenced_json_extract(v: Views) -> DataFrame:
    e = v.table("events")
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nDone {"))).otherwise(F.concat(F.lit("It is "), "props", F.lit(" I think")))
    return e.select("event_id", t.json_body(raw).alias("body"))


@query(r"WITH x AS (SELECT ord, s, lower(s) AS l FROM (SELECT ord, unnest(string_split(comment, '.')) AS s FROM fx_comments)) SELECT ord, count(*) AS kept FROM x WHERE NOT ((len(regexp_extract_all(l, '[^ \t\n\r]+')) < 20 AND list_contains(regexp_extract_all(l, '[^ \t\n\r]+'), 'no')) OR contains(l, 'not mentioned') OR contains(l, 'no content')) GROUP BY 1")
def weak_text_filter(v: Views) -> DataFrame:
    items = v.comments().select("ord", F.explode(F.split("comment", r"\.")).alias("s"))
    return items.where(~t.weak(F.col("s"))).groupBy("ord").agg(F.count("*").alias("kept"))


@query(r"WITH x AS (SELECT ord, list_filter(string_split(comment, '.'), lambda s: NOT (len(regexp_extract_all(lower(s), '[^ \t\n\r]+')) < 20 AND list_contains(regexp_extract_all(lower(s), '[^ \t\n\r]+'), 'no'))) AS p FROM fx_comments) SELECT ord, cast(CASE WHEN len(p) > 0 THEN 1 ELSE 0 END AS int) AS n_sections, cast(len(p) AS int) AS n_positions FROM x WHERE len(p) > 0")
def clean_extract(v: Views) -> DataFrame:
    raw = F.create_map(F.lit("positions"), F.split("comment", r"\."), F.lit("concerns"), F.array(F.lit("No specific concerns")), F.lit("other"), F.array(F.lit("x")))
    # A filter would clean all extracts once more.
    out = v.comments().select("ord", F.explode(F.array_compact(F.array(t.clean_extract(raw)))).alias("e"))
    return out.select("ord", F.size("e").alias("n_sections"), F.size(F.element_at("e", F.lit("positions"))).alias("n_positions"))


ENDED = "CASE ord % 12 WHEN 0 THEN concat(category, ' in the U.S') WHEN 1 THEN concat(comment, ' u.k') WHEN 2 THEN concat(comment, ' VS') WHEN 3 THEN concat(comment, ' Dr') WHEN 4 THEN concat(comment, ' mr') WHEN 5 THEN concat(comment, ' Mrs') WHEN 6 THEN concat(comment, ' Ms') WHEN 7 THEN concat(comment, ' Inc') WHEN 8 THEN concat(comment, ' ltd') WHEN 9 THEN concat(comment, ' Corp') WHEN 10 THEN concat(category, '. x') ELSE comment END"


@query(f"WITH x AS (SELECT ord, {ENDED} AS d FROM fx_comments) SELECT ord, regexp_matches(d, ' (U\\.S|U\\.K|vs|Dr|Mr|Mrs|Ms|Inc|Ltd|Corp)$', 'i') OR (length(d) < 50 AND NOT contains(d, '.')) AS cut FROM x")
def truncated_like(v: Views) -> DataFrame:
    return v.comments().select("ord", t.cut_description(F.expr(ENDED)).alias("cut"))


@query("SELECT short, max(id) AS id FROM (SELECT id, split_part(id, '-', 2) AS short FROM fx_comments) GROUP BY 1 HAVING count(DISTINCT id) = 1")
def suffix_id_repair(v: Views) -> DataFrame:
    from dockmill.operators.generate import suffix_ids

    return suffix_ids(v.comments().select("id")).select(F.col("suffix").alias("short"), "id")


# ---------------------------------------------------------------- entities, batches


@query(r"WITH hits AS (SELECT c.id, x.category, x.label FROM fx_comments c JOIN fx_terms x ON contains(c.comment, x.term) AND regexp_matches(c.comment, concat(CASE WHEN regexp_matches(x.term, '^[A-Za-z0-9_]') THEN '(^|[^A-Za-z0-9_])' ELSE '[A-Za-z0-9_]' END, regexp_escape(x.term), CASE WHEN regexp_matches(x.term, '[A-Za-z0-9_]$') THEN '($|[^A-Za-z0-9_])' ELSE '[A-Za-z0-9_]' END))) SELECT DISTINCT id, category, label FROM hits")
def entity_dictionary_match(v: Views) -> DataFrame:
    return entities.annotate(v.comments(), "id", "comment", v.terms())


@query("WITH h AS (SELECT category, entity_label AS label, count(DISTINCT comment_id) AS hits FROM fx_comment_entities GROUP BY 1, 2), n AS (SELECT count(DISTINCT comment_id) AS n FROM fx_comment_entities) SELECT category, label, hits FROM h, n WHERE hits >= greatest(1, floor(n * 0.01)) AND hits <= floor(n * 0.5)")
def entity_frequency_band(v: Views) -> DataFrame:
    e = v.comment_entities().withColumnRenamed("entity_label", "label")
    return entities.frequency_band(e, "comment_id", e.agg(F.countDistinct("comment_id").alias("n")))


@query(f"SELECT ord, cast(floor(percent_rank() OVER (ORDER BY {WC.format('comment')}) * 100 + 0.5) AS int) AS percentile FROM fx_comments")
def percentile_rank(v: Views) -> DataFrame:
    rows = v.comments().select("ord", t.word_count(F.col("comment")).alias("words"))
    return explore.percentile(rows, "words").select("ord", "percentile")


@query(f"WITH x AS (SELECT ord, {WC.format('comment')} AS w, sha256(id) AS h FROM fx_comments), s AS (SELECT *, coalesce(sum(w) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM x), f AS (SELECT *, max(CASE WHEN b + w > 150000 AND b > 135000 THEN 1 ELSE 0 END) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM s) SELECT ord, w AS words FROM f WHERE stop = 0")
def budget_sample_hash(v: Views) -> DataFrame:
    rows = v.comments().select("ord", t.word_count(F.col("comment")).cast("long").alias("words"), F.sha2("id", 256).alias("h"))
    return batching.budget_sample(rows, "words", 150_000, "h").select("ord", "words")


@query(r"""/*recursive*/ WITH x AS (SELECT conv_id, turn, len(regexp_extract_all(text, '[^ \t\n\r]+')) AS w, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i0, sum(len(regexp_extract_all(text, '[^ \t\n\r]+'))) OVER (PARTITION BY conv_id) AS total FROM conversations),
r AS (SELECT conv_id, turn, i0, w AS s, 1::bigint AS batch, total FROM x WHERE i0 = 1 UNION ALL
SELECT x.conv_id, x.turn, x.i0, CASE WHEN x.total > 60 AND r.s + x.w > 40 AND r.s > 0 THEN x.w ELSE r.s + x.w END, CASE WHEN x.total > 60 AND r.s + x.w > 40 AND r.s > 0 THEN r.batch + 1 ELSE r.batch END, x.total FROM r JOIN x ON x.conv_id = r.conv_id AND x.i0 = r.i0 + 1)
SELECT conv_id, turn, batch FROM r""")
def sequential_batches(v: Views) -> DataFrame:
    rows = v.table("conversations").select("conv_id", "turn", t.word_count(F.col("text")).cast("long").alias("w"))
    return batching.sequential_batches(rows, "conv_id", "turn", "w", 60, 40)


@query(r"""/*recursive*/ WITH x AS (SELECT conv_id, turn, len(regexp_extract_all(text, '[^ \t\n\r]+')) AS w, row_number() OVER (PARTITION BY conv_id ORDER BY len(regexp_extract_all(text, '[^ \t\n\r]+')) DESC, turn) AS i0, cast(greatest(1, ceil(sum(len(regexp_extract_all(text, '[^ \t\n\r]+'))) OVER (PARTITION BY conv_id) / 40)) AS bigint) AS k FROM conversations),
r AS (SELECT DISTINCT conv_id, 0::bigint AS i0, NULL::bigint AS turn, NULL::bigint AS batch, list_transform(range(k), lambda b: 0::bigint) AS loads FROM x UNION ALL
SELECT x.conv_id, x.i0, x.turn, list_position(loads, list_min(loads)) - 1, list_transform(range(1, len(loads) + 1), lambda b: CASE WHEN b = list_position(loads, list_min(loads)) THEN loads[b] + x.w ELSE loads[b] END) FROM r JOIN x ON x.conv_id = r.conv_id AND x.i0 = r.i0 + 1)
SELECT conv_id, turn, batch FROM r WHERE i0 > 0""")
def even_batches(v: Views) -> DataFrame:
    rows = v.table("conversations").select("conv_id", "turn", t.word_count(F.col("text")).cast("long").alias("w"))
    return batching.even_batches(rows, "conv_id", "turn", "w", 40)


@query("WITH x AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i0, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) SELECT l_orderkey, l_linenumber, ntile_group AS merge_group FROM (SELECT l_orderkey, l_linenumber, cast(CASE WHEN i0 < (n % g) * (n // g + 1) THEN i0 // (n // g + 1) ELSE (n % g) + (i0 - (n % g) * (n // g + 1)) // (n // g) END AS bigint) AS ntile_group FROM (SELECT *, cast(ceil(n / 3) AS bigint) AS g FROM x))")
def merge_tree_groups(v: Views) -> DataFrame:
    rows = v.table("lineitem").select("l_orderkey", "l_linenumber").withColumn("o", F.col("l_linenumber"))
    return batching.merge_plan(rows, "l_orderkey", "o", 3).drop("o")


# ---------------------------------------------------------------- search, facets, rollups

TEXT = "lower(concat_ws(' ', nullif(comment, ''), nullif(organization, ''), id))"


def _searchable(v: Views) -> DataFrame:
    c = v.comments().withColumn("search_text", explore.search_text(F.col("comment"), F.col("organization"), F.col("id")))
    scores = F.create_map(F.lit("1"), (F.col("ord") % 4).cast("int"), F.lit("2.1"), (F.col("ord") % 3).cast("int"))
    named = F.when(F.col("ord") % 7 == 0, F.array(F.struct(F.lit("Place").alias("category"), F.col("region").alias("label")))).otherwise(F.array().cast("array<struct<category:string,label:string>>"))
    return c.withColumns({"theme_scores": scores, "entities": named, "submitter_type": F.col("category"), "is_representative": F.when(F.col("ord") % 11 != 0, F.col("ord") % 2 == 0)})


def _index(v: Views) -> search_index.TextIndex:
    keep = ["id", "theme_scores", "entities", "submitter_type"]
    return search_index.index_of(_searchable(v), F.col("search_text"), "comments", keep=keep, facets=search_index.comment_facets())


def _search(v: Views, q: str = "", **facets) -> DataFrame:
    return _index(v).search(explore.parse_search(q), search_index.wanted_facets(**facets)).select("id")


@query(f"SELECT id FROM fx_comments WHERE contains({TEXT}, 'thre') AND contains({TEXT}, 'org')")
def search_and(v: Views) -> DataFrame:
    return _search(v, "thre ORG")


@query(f"SELECT id FROM fx_comments WHERE contains({TEXT}, 'ció') OR contains({TEXT}, 'keit')")
def search_or(v: Views) -> DataFrame:
    return _search(v, "ció OR keit")


@query(f"SELECT id FROM fx_comments WHERE contains({TEXT}, 'the') AND NOT contains({TEXT}, 'org src1')")
def search_negation(v: Views) -> DataFrame:
    return _search(v, 'the -"org src1"')


@query(f"SELECT id FROM fx_comments WHERE contains({TEXT}, 'of the')")
def search_phrase(v: Views) -> DataFrame:
    return _search(v, '"of the')


@query("SELECT id FROM fx_comments WHERE ord % 4 IN (1, 2) OR ord % 3 IN (1, 2)")
def facet_theme(v: Views) -> DataFrame:
    return _search(v, themes=["1", "2.1", "9"])


@query("SELECT id FROM fx_comments WHERE ord % 7 = 0 AND region IN ('de', 'fr')")
def facet_entity(v: Views) -> DataFrame:
    return _search(v, entities=[("Place", "de"), ("Place", "fr")])


@query("SELECT id FROM fx_comments WHERE category IN ('src1', 'src2')")
def facet_type(v: Views) -> DataFrame:
    return _search(v, types=["src1", "src2"])


@query(f"SELECT id FROM fx_comments WHERE category IN ('src1', 'src2', 'src3') AND ord % 4 IN (1, 2) AND contains({TEXT}, 'en')")
def facet_combined(v: Views) -> DataFrame:
    return _search(v, "en", types=["src1", "src2", "src3"], themes=["1"])


@query(f"SELECT category AS value, count(*) AS n FROM fx_comments WHERE ord % 4 IN (1, 2) AND contains({TEXT}, 'ting') AND NOT contains({TEXT}, 'org src1') GROUP BY 1")
def facet_counts(v: Views) -> DataFrame:
    """How many comments on a theme that a search finds each submitter type has."""
    return _index(v).counts("type", explore.parse_search('ting -"org src1"'), search_index.wanted_facets(themes=["1"]))


@query("SELECT id FROM fx_comments WHERE ord % 11 <> 0 AND ord % 2 = 0")
def representatives_only(v: Views) -> DataFrame:
    return explore.representatives_only(_searchable(v)).select("id")


@query("SELECT id FROM fx_comments WHERE ord % 11 = 0 OR ord % 2 = 0")
def theme_detail_comments(v: Views) -> DataFrame:
    return explore.detail_comments(_searchable(v)).select("id")


@query("SELECT category AS submitter_type, count(*) AS n FROM fx_comments GROUP BY 1 HAVING count(*) >= 5 ORDER BY 2 DESC, 1 LIMIT 5")
def stakeholder_top5(v: Views) -> DataFrame:
    return explore.top_types(_searchable(v))


@query("SELECT region, count(*) AS n FROM fx_comments WHERE region IS NOT NULL GROUP BY 1 HAVING count(*) >= 5")
def distinct_values(v: Views) -> DataFrame:
    return explore.distinct_values(v.comments(), "region", 5)


@query("WITH ids AS (SELECT DISTINCT comment_id FROM fx_comment_entities WHERE category = (SELECT min(category) FROM fx_comment_entities) AND entity_label = (SELECT min(entity_label) FROM fx_comment_entities WHERE category = (SELECT min(category) FROM fx_comment_entities))) SELECT theme_code, count(*) AS n FROM (SELECT DISTINCT comment_id, theme_code FROM fx_extracts) JOIN ids USING (comment_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def theme_distribution_top10(v: Views) -> DataFrame:
    first = v.comment_entities().agg(F.min(F.struct("category", "entity_label")).alias("x")).select("x.*")
    return explore.theme_distribution(v.comment_entities(), v.extracts(), first)


@query("SELECT cast(floor(100.0 * count(organization) / count(*) + 0.5) AS int) AS pct FROM fx_comments")
def attachment_share(v: Views) -> DataFrame:
    return explore.share(v.comments(), F.col("organization").isNotNull(), "pct")


@query("SELECT code, row_number() OVER (ORDER BY n DESC, code)::integer AS position FROM (SELECT p.code, count(c.code) AS n FROM fx_themes p LEFT JOIN fx_themes c ON c.parent_code = p.code GROUP BY 1)")
def summary_sort_by_size(v: Views) -> DataFrame:
    kids = collection.children(v.themes()).withColumn("sections", F.struct(F.col("children").alias("consensusPoints")))
    ordered = explore.sort_summaries(kids, "consensus")
    return _placed(ordered, "code")


def _placed(ordered: DataFrame, *columns: str) -> DataFrame:
    """The order of a small sorted table as a column ``position`` from 1."""
    return ordered.coalesce(1).select(*columns, (F.monotonically_increasing_id() + 1).cast("int").alias("position"))


@query("SELECT id FROM fx_comments ORDER BY ord LIMIT 25 OFFSET 75")
def pagination(v: Views) -> DataFrame:
    return explore.page(v.comments(), [F.col("ord")], 3, 25).select("id")


@query("SELECT cast(ceil(count(*) / 25) AS bigint) AS pages FROM fx_comments")
def page_count(v: Views) -> DataFrame:
    return explore.page_count(v.comments(), 25)


@query("SELECT category, label FROM fx_taxonomy WHERE contains(lower(label), 'al')")
def picker_items(v: Views) -> DataFrame:
    return explore.picker(v.taxonomy().withColumn("n", F.lit(1)), "label", "n", "AL").select("category", "label")


@query("SELECT comment_id, CASE WHEN cluster_size >= 100 THEN 'form letter' WHEN cluster_size >= 10 THEN 'cluster' WHEN cluster_size > 1 THEN 'small cluster' ELSE 'individual' END AS label FROM fx_membership")
def cluster_labels(v: Views) -> DataFrame:
    return v.membership().select("comment_id", t.size_label(F.col("cluster_size")).alias("label"))


@query("SELECT l_orderkey AS comment_id, string_agg(concat('--- ', l_linenumber, ' ---', chr(10), l_returnflag), chr(10) || chr(10) ORDER BY l_linenumber, l_returnflag) AS content FROM lineitem GROUP BY 1")
def attachment_texts(v: Views) -> DataFrame:
    part = F.concat(F.lit("--- "), F.col("l_linenumber").cast("string"), F.lit(" ---\n"), F.col("l_returnflag"))
    return collection.joined_texts(v.table("lineitem"), [F.col("l_orderkey").alias("comment_id")], "l_linenumber", part, "\n\n").withColumnRenamed("text", "content")


# ---------------------------------------------------------------- smaller operators


@query("SELECT count(*) AS entities, cast(sum(n) AS bigint) AS mentions FROM (SELECT category, entity_label, count(*) AS n FROM fx_comment_entities GROUP BY 1, 2)")
def entity_totals(v: Views) -> DataFrame:
    return explore.entity_totals(_counted_entities(v))


def _counted_entities(v: Views) -> DataFrame:
    return v.comment_entities().groupBy("category", F.col("entity_label").alias("label")).agg(F.count("*").alias("mention_count"))


@query("SELECT category, count(*) AS entities, cast(sum(n) AS bigint) AS mentions FROM (SELECT category, entity_label, count(*) AS n FROM fx_comment_entities GROUP BY 1, 2) GROUP BY 1")
def entity_categories(v: Views) -> DataFrame:
    return explore.categories(_counted_entities(v))


@query("SELECT theme_code, cast(sum(cluster_size) AS bigint) AS submissions, count(*) AS perspectives, CASE WHEN sum(cluster_size) <> count(*) THEN concat(cast(sum(cluster_size) AS bigint), ' submissions with ', count(*), ' distinct texts') END AS note FROM fx_extracts GROUP BY 1")
def represented_totals(v: Views) -> DataFrame:
    from dockmill.operators.stages import represented

    return represented(v.extracts(), "theme_code")


@query("SELECT region, ord // 50 AS block, string_agg(coalesce(comment, ''), chr(10) ORDER BY ord) AS text FROM fx_comments GROUP BY 1, 2")
def ordered_texts(v: Views) -> DataFrame:
    """Texts in order, by region and block of 50 ids, so that no group grows with the table."""
    return collection.joined_texts(v.comments(), [F.col("region"), F.floor(F.col("ord") / 50).alias("block")], "ord", F.col("comment"), "\n")


@query("SELECT code, level, parent_code, description AS body FROM fx_themes")
def theme_segments(v: Views) -> DataFrame:
    from dockmill.functions.parsers import theme_segments as segments

    outline = v.themes().agg(F.array_join(F.array_sort(F.collect_list(F.concat("code", F.lit(". "), "description"))), "\n").alias("text"))  # themes of one collection
    return segments(outline, "text")


@query(r"WITH p AS (SELECT ord, string_split_regex(comment, '\.[ \t\n\x0B\f\r]+') AS p FROM fx_comments) SELECT ord, CASE WHEN len(p) >= 2 THEN CASE WHEN regexp_matches(p[1], ' (U\.S|U\.K|vs|Dr|Mr|Mrs|Ms|Inc|Ltd|Corp)$') THEN concat(p[1], '. ', p[2]) ELSE p[1] END END AS sentence FROM p")
def first_sentences(v: Views) -> DataFrame:
    """Of every text, with the repair of abbreviations; null where no sentence ends."""
    return v.comments().select("ord", t.first_sentence(F.col("comment")).alias("sentence"))


@query(r"WITH w AS (SELECT ord, list_distinct(list_filter(string_split_regex(lower(comment), '[^a-z0-9_]+'), lambda x: length(x) > 2)) AS w FROM fx_comments) SELECT x.ord AS a, y.ord AS b, round(len(list_intersect(x.w, y.w)) / nullif(len(list_distinct(list_concat(x.w, y.w))), 0), 6) AS similarity FROM w x JOIN w y ON y.ord = x.ord + 1")
def word_jaccard(v: Views) -> DataFrame:
    """Each document and the next; null for two without words."""
    w = v.comments().select("ord", shingles.feature_ids(F.col("comment"), "words").alias("w"))
    nxt = w.select((F.col("ord") - 1).alias("ord"), F.col("ord").alias("b"), F.col("w").alias("v"))
    return w.join(nxt, "ord").select(F.col("ord").alias("a"), "b", F.round(similarity.jaccard(F.col("w"), F.col("v"), None), 6).alias("similarity"))


@query("SELECT source AS document_id, concat('Collection ', source) AS title, 'Unknown' AS agency, count(*) AS comments, cast(count(DISTINCT lang) AS bigint) AS languages FROM documents GROUP BY 1")
def catalogue(v: Views) -> DataFrame:
    per = v.table("documents").groupBy(F.col("source").alias("document_id")).agg(F.count("*").alias("comments"), F.countDistinct("lang").alias("languages"))
    full = per.withColumns({"title": F.concat(F.lit("Collection "), "document_id"), "agency_name": F.lit(""), "agency_id": F.lit(None).cast("string"), "last_date": F.lit("2026")})
    return collection.aligned_catalogue(full).select("document_id", "title", "agency", "comments", "languages")


from dockmill import queries_documents, queries_views  # noqa: E402, F401  they register theirs
