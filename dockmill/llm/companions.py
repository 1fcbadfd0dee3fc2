"""Queries with SQL for the columns of op4, op5, op9 and op10 that rules fix, each through its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.llm.pii import COUNTS, op5_pii
from dockmill.llm.quality import MEASURES, op10_quality
from dockmill.llm.sharding import op9_sharding
from dockmill.llm.urls import OP4_RULES, op4_urls


def base4_urls(spark, sf_dir: str) -> DataFrame:
    """Host, path, rule and the rule's verdict of every page."""
    return op4_urls(spark, sf_dir).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


def base5_pii(spark, sf_dir: str) -> DataFrame:
    """Counts and base spans of every document."""
    return op5_pii(spark, sf_dir).select("doc_id", *COUNTS, "base_sha256")


def base9_shards(spark, sf_dir: str) -> DataFrame:
    """Per shard its rows, whether its slots have no gap, and the sizes' law; bytes of all rows."""
    per = op9_sharding(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.min("slot").alias("first"), F.max("slot").alias("last"), F.sum("size").alias("bytes"))
    total = per.agg(F.sum("bytes").alias("total_bytes"))
    return per.crossJoin(total).select("shard", "n", ((F.col("slots") == F.col("n")) & (F.col("first") == 0) & (F.col("last") == F.col("n") - 1)).alias("gapless"), "total_bytes")  # one row on the right


def base10_quality(spark, sf_dir: str) -> DataFrame:
    """Measures and the base verdict of every document."""
    return op10_quality(spark, sf_dir).select("doc_id", *MEASURES, "base_failed")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULES = ", ".join(f"('{r}', '{r.split('/')[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in OP4_RULES)
BASE4_SQL = f"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule, rule_host, start, verdict) AS (VALUES {_RULES}),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS rule_verdict
      FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, start) GROUP BY 1)
SELECT h.page_id, host, path, rule, rule_verdict FROM h LEFT JOIN m ON m.page_id = h.page_id
"""

_DIGITS = r"regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN cast(substr(reverse({_DIGITS}), i, 1) AS int) ELSE (2 * cast(substr(reverse({_DIGITS}), i, 1) AS int)) // 10 + (2 * cast(substr(reverse({_DIGITS}), i, 1) AS int)) % 10 END)) % 10 = 0"
_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS int), 0) > 255)) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"CASE WHEN length({_DIGITS}) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
]
# The gaps between matches and the matches' lengths give the places.
_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, m, start FROM (SELECT doc_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i: list_sum(list_transform(gs[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))) AS start
FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d) WHERE len(ms) > 0) WHERE {fits}"""
    for k, (kind, pattern, fits) in enumerate(_KINDS)
)
BASE5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_FOUND}),
s AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, _, _ in _KINDS)}, string_agg(concat(kind, ':', cast(start AS bigint), ':', cast(start AS bigint) + length(m)), ',' ORDER BY k, start) AS joined FROM f GROUP BY 1)
SELECT d.doc_id, {', '.join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, _, _ in _KINDS)}, sha256(coalesce(joined, '')) AS base_sha256 FROM d LEFT JOIN s ON s.doc_id = d.doc_id
"""

BASE9_SQL = """
WITH t AS (SELECT count(*) AS n, cast(sum(strlen(coalesce(text, '')) + 8) AS bigint) AS total_bytes FROM documents)
SELECT cast(shard AS int) AS shard, n // 24 + CASE WHEN shard < n % 24 THEN 1 ELSE 0 END AS n, true AS gapless, total_bytes FROM t, range(24) AS s(shard) WHERE n // 24 + CASE WHEN shard < n % 24 THEN 1 ELSE 0 END > 0
"""

BASE10_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i0, concat_ws(' ', w[i0], w[i0 + 1], w[i0 + 2]) AS g FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 1))) AS i0)),
r AS (SELECT doc_id, i0, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
p AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i0, i0 + 1, i0 + 2]) AS pos FROM r WHERE n > 1) GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
b AS (SELECT w.doc_id, cast(len(w) AS bigint) AS n_words, cast(length(array_to_string(w, '')) AS bigint) AS word_chars, cast(len(regexp_extract_all(t, '[#*$%&|<>]')) AS bigint) AS n_symbols,
             cast(len(l) - len(list_distinct(l)) AS bigint) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
      FROM w JOIN l ON l.doc_id = w.doc_id LEFT JOIN p ON p.doc_id = w.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b
"""

QUERIES = {"base4_urls": base4_urls, "base5_pii": base5_pii, "base9_shards": base9_shards, "base10_quality": base10_quality}
ORACLES = {"base4_urls": BASE4_SQL, "base5_pii": BASE5_SQL, "base9_shards": BASE9_SQL, "base10_quality": BASE10_SQL}
