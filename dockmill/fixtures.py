"""Views that turn the plain test tables into the engine's input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.plans.shared import small, spread


class Views:
    """Engine tables over a folder of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return spread(table) if name in ("documents", "pages", "conversations") else table  # what is done with texts takes long

    def comments(self) -> DataFrame:
        d = self.table("documents")
        return d.select(
            F.concat(F.lit("DOC-"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("id"),
            F.col("doc_id").alias("ord"),
            F.col("text").alias("comment"),
            F.col("source").alias("category"),
            F.col("lang").alias("region"),
            F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("Org "), "source")).alias("organization"),
        )

    def submissions(self) -> DataFrame:
        """Comments with their attributes as JSON; every attribute is missing or blank in some."""
        c, o = self.comments(), F.col("ord")
        attributes = {
            "comment": F.when(o % 13 != 0, F.col("comment")).otherwise("  "),
            "organization": F.coalesce("organization", F.lit("")),
            "firstName": F.when(o % 3 == 0, F.concat(F.lit("Ann"), (o % 7).cast("string"))),
            "lastName": F.when(o % 4 == 0, "Lee").otherwise(""),
            "category": F.when(o % 9 != 0, F.col("category")),
            "city": F.when(o % 2 == 0, F.concat(F.lit("City"), (o % 3).cast("string"))),
            "stateProvinceRegion": F.col("region"),
            "country": F.when(o % 6 == 0, "United States").when(o % 6 == 1, "Canada").when(o % 6 == 2, ""),
            "postedDate": F.when(o % 8 != 0, "2024-01-02T00:00:00Z"),
            "receiveDate": F.when(o % 16 != 0, "2023-05-06"),
        }
        return c.select("id", "ord", F.to_json(F.struct(*(x.alias(k) for k, x in attributes.items()))).alias("attributes_json"))

    def files(self) -> DataFrame:
        key = F.concat(F.lit("DOC-"), F.lpad(F.col("l_orderkey").cast("string"), 7, "0"))
        text = F.when(F.col("l_returnflag") == "A", " ").when(F.col("l_returnflag") == "N", "(error extracting pdf)").otherwise(F.concat(F.lit("\n page "), F.col("l_partkey").cast("string")))
        return self.table("lineitem").groupBy(key.alias("comment_id"), F.col("l_linenumber").alias("ord")).agg(F.lit("pdf").alias("format"), F.concat(F.lit("f"), F.first("l_linenumber").cast("string"), F.lit(".pdf")).alias("file_name"), F.min(text).alias("text"))

    def sections(self) -> DataFrame:
        """Condensed comments; some sections say that there is nothing."""
        o = F.col("ord")
        found = F.map_from_arrays(
            F.array(*(F.lit(k) for k in ("oneLineSummary", "corePosition", "keyRecommendations", "mainConcerns"))),
            F.array("category", F.col("region"), F.when(o % 4 == 0, "No specific recommendations provided").otherwise(F.concat(F.lit("do "), o.cast("string"))), F.when(o % 5 == 0, "").otherwise("cost")),
        )
        return self.comments().select(F.col("id").alias("comment_id"), "ord", found.alias("structured_sections"), F.when(o % 10 != 0, "completed").otherwise("failed").alias("status"))

    def clusters(self) -> DataFrame:
        """Clusters of the membership, one row each."""
        rep = F.max(F.when(F.col("is_representative"), F.col("comment_id")))
        return self.membership().groupBy("cluster_id").agg(rep.alias("representative_comment_id"), F.count("*").alias("cluster_size"))

    def runs(self) -> DataFrame:
        """Clustering runs, in several states."""
        state = F.when(F.col("c_custkey") % 3 == 0, "completed").otherwise("running")
        return self.table("customer").select(F.col("c_custkey").alias("total_comments"), (F.col("c_custkey") % 100).alias("total_clusters"), state.alias("status"), F.col("c_custkey").alias("created_at"))

    def status(self) -> DataFrame:
        state = F.when(F.col("quality") == 1, "completed").when(F.col("toxic") == 1, "failed").otherwise("pending")
        return self.table("labels").select(F.concat(F.lit("DOC-"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("comment_id"), state.alias("status"), F.col("toxic").alias("attempt_count"))

    def theme_l2(self) -> DataFrame:
        nr = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
        top = (F.col("n_regionkey") + 1).cast("string")
        return self.table("nation").select(F.concat(top, F.lit("."), nr.cast("string")).alias("code"), F.col("n_name").alias("description"), F.lit(2).alias("level"), top.alias("parent_code"), "n_nationkey")

    def themes(self) -> DataFrame:
        top = self.table("region").select((F.col("r_regionkey") + 1).cast("string").alias("code"), F.col("r_name").alias("description"), F.lit(1).alias("level"), F.lit(None).cast("string").alias("parent_code"))
        return top.unionByName(self.theme_l2().drop("n_nationkey"))

    def extracts(self) -> DataFrame:
        # The few themes would be the keys of a join by shuffle, each with its share of all lines.
        themes = self.table("supplier").join(small(self.theme_l2(), 10_000), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "code")
        rows = self.table("lineitem").join(small(themes, 1_000_000), F.col("l_suppkey") == F.col("s_suppkey"))
        return rows.groupBy(F.col("l_orderkey").alias("comment_id"), F.col("code").alias("theme_code")).agg(F.count("*").alias("cluster_size"))

    def taxonomy(self) -> DataFrame:
        real = self.table("part").select(F.col("p_brand").alias("category"), F.col("p_type").alias("label")).distinct()
        return real.unionAll(self.spark.createDataFrame([("Brand#none", "NONE")], "category string, label string"))

    def comment_entities(self) -> DataFrame:
        rows = self.table("lineitem").where("l_quantity > 45").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return rows.select(F.col("l_orderkey").alias("comment_id"), F.col("p_brand").alias("category"), F.col("p_type").alias("entity_label")).distinct()

    def membership(self) -> DataFrame:
        first = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")) == 1
        size = F.count("*").over(Window.partitionBy("o_custkey"))
        return self.table("orders").select(F.col("o_orderkey").alias("comment_id"), F.col("o_custkey").alias("cluster_id"), first.alias("is_representative"), size.alias("cluster_size"))

    def cache(self) -> DataFrame:
        return self.table("events").select(
            F.sha2(F.col("event_id").cast("string"), 256).alias("prompt_hash"), F.col("event_type").alias("task_type"), (F.col("user_id") % 3).alias("task_level"),
            F.col("props").alias("task_params"), F.col("value").alias("result"), F.col("ts").alias("created_at"), "event_id",
        )

    def terms(self) -> DataFrame:
        w = F.filter(F.split("text", r"\s+"), lambda x: x != "")
        return self.table("benchmark").select(F.lit("Benchmark").alias("category"), F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("label"), F.array(F.array_join(F.slice(w, 2, 2), " ")).alias("terms"))


#: The same views in DuckDB's SQL, by name.
SQL = {
    "fx_people": "SELECT id, ord, CASE WHEN ord % 13 <> 0 THEN nullif(comment, '') ELSE '  ' END AS text, organization, CASE WHEN ord % 3 = 0 THEN concat('Ann', ord % 7) END AS first, CASE WHEN ord % 4 = 0 THEN 'Lee' END AS last, CASE WHEN ord % 9 <> 0 THEN category END AS category, CASE WHEN ord % 2 = 0 THEN concat('City', ord % 3) END AS city, region AS state, CASE ord % 6 WHEN 0 THEN 'United States' WHEN 1 THEN 'Canada' END AS country, CASE WHEN ord % 8 <> 0 THEN '2024-01-02T00:00:00Z' END AS posted, CASE WHEN ord % 16 <> 0 THEN '2023-05-06' END AS received FROM fx_comments",
    "fx_meta": "SELECT id, ord, text, organization, coalesce(organization, nullif(concat_ws(' ', first, last), ''), 'Anonymous') AS submitter, coalesce(category, CASE WHEN organization IS NOT NULL THEN 'Organization' ELSE 'Individual' END) AS submitter_type, nullif(concat_ws(', ', city, state, CASE WHEN country <> 'United States' THEN country END), '') AS location, coalesce(posted, received) AS date FROM fx_people",
    "fx_files": "SELECT concat('DOC-', lpad(cast(l_orderkey AS varchar), 7, '0')) AS comment_id, l_linenumber AS ord, concat('f', l_linenumber, '.pdf') AS file_name, min(CASE l_returnflag WHEN 'A' THEN ' ' WHEN 'N' THEN '(error extracting pdf)' ELSE concat(chr(10), ' page ', l_partkey) END) AS text FROM lineitem GROUP BY 1, 2, 3",
    "fx_enriched": "SELECT id, ord, concat_ws(chr(10), '=== COMMENT METADATA ===', concat('ID: ', id), concat('Date: ', coalesce(date, 'Unknown')), concat('Submitter: ', submitter), concat('Type: ', submitter_type), CASE WHEN organization IS NOT NULL THEN concat('Organization: ', organization) END, CASE WHEN location IS NOT NULL THEN concat('Location: ', location) END, concat(chr(10), '=== COMMENT TEXT ==='), text, concat(chr(10), '=== ATTACHMENTS ===', chr(10)) || block) AS content FROM fx_meta LEFT JOIN (SELECT comment_id, string_agg(CASE WHEN trim(text, E' \\n') <> '' AND trim(text, E' \\n') NOT LIKE '(%' THEN concat(chr(10), 'PDF: ', file_name, chr(10), trim(text, E' \\n')) ELSE concat(chr(10), 'PDF: ', file_name, ' ', coalesce(nullif(trim(text, E' \\n'), ''), '(no extractable text)')) END, chr(10) ORDER BY ord) AS block FROM fx_files GROUP BY 1) b ON b.comment_id = id WHERE trim(text, E' \\n\\t') <> ''",
    "fx_sections": "SELECT id AS comment_id, ord, category AS one_line, region AS core_position, CASE WHEN ord % 4 <> 0 THEN concat('do ', ord) END AS recommendations, CASE WHEN ord % 5 <> 0 THEN 'cost' END AS concerns, CASE WHEN ord % 10 <> 0 THEN 'completed' ELSE 'failed' END AS status FROM fx_comments",
    "fx_clusters": "SELECT cluster_id, max(CASE WHEN is_representative THEN comment_id END) AS representative_comment_id, count(*) AS cluster_size FROM fx_membership GROUP BY 1",
    "fx_runs": "SELECT c_custkey AS total_comments, c_custkey % 100 AS total_clusters, CASE WHEN c_custkey % 3 = 0 THEN 'completed' ELSE 'running' END AS status, c_custkey AS created_at FROM customer",
    "fx_comments": "SELECT concat('DOC-', lpad(cast(doc_id AS varchar), 7, '0')) AS id, doc_id AS ord, text AS comment, source AS category, lang AS region, CASE WHEN doc_id % 5 = 0 THEN concat('Org ', source) END AS organization FROM documents",
    "fx_status": "SELECT concat('DOC-', lpad(cast(doc_id AS varchar), 7, '0')) AS comment_id, CASE WHEN quality = 1 THEN 'completed' WHEN toxic = 1 THEN 'failed' ELSE 'pending' END AS status, toxic AS attempt_count FROM labels",
    "fx_theme_l2": "SELECT concat(n_regionkey + 1, '.', row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)) AS code, n_name AS description, 2 AS level, cast(n_regionkey + 1 AS varchar) AS parent_code, n_nationkey FROM nation",
    "fx_themes": "SELECT cast(r_regionkey + 1 AS varchar) AS code, r_name AS description, 1 AS level, NULL::varchar AS parent_code FROM region UNION ALL SELECT code, description, level, parent_code FROM fx_theme_l2",
    "fx_extracts": "SELECT l_orderkey AS comment_id, code AS theme_code, count(*) AS cluster_size FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN fx_theme_l2 ON s_nationkey = n_nationkey GROUP BY 1, 2",
    "fx_taxonomy": "SELECT DISTINCT p_brand AS category, p_type AS label FROM part UNION ALL SELECT 'Brand#none', 'NONE'",
    "fx_comment_entities": "SELECT DISTINCT l_orderkey AS comment_id, p_brand AS category, p_type AS entity_label FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 45",
    "fx_membership": "SELECT o_orderkey AS comment_id, o_custkey AS cluster_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1 AS is_representative, count(*) OVER (PARTITION BY o_custkey) AS cluster_size FROM orders",
    "fx_cache": "SELECT sha256(cast(event_id AS varchar)) AS prompt_hash, event_type AS task_type, user_id % 3 AS task_level, props AS task_params, value AS result, ts AS created_at, event_id FROM events",
    "fx_terms": "SELECT 'Benchmark' AS category, concat('item ', item_id) AS label, array_to_string(list_slice(regexp_extract_all(text, '[^ \\t\\n\\r]+'), 2, 3), ' ') AS term FROM benchmark",
}


def sql(body: str) -> str:
    """``body`` after the definitions of the views that it needs."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in SQL:
            if name in text and name not in needed and not any(name != o and name in o and o in text and text.count(name) == text.count(o) for o in SQL):
                need(SQL[name])
                needed.append(name)

    need(body)
    recursive = "RECURSIVE " if "/*recursive*/" in body else ""
    defs = ", ".join(f"{n} AS ({SQL[n]})" for n in dict.fromkeys(needed))
    body = body.replace("/*recursive*/", "").strip()
    if body.upper().startswith("WITH "):
        body = (", " if defs else "") + body[5:]
        return f"WITH {recursive}{defs}{body}"
    return f"WITH {recursive}{defs} {body}" if defs else body
