"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

Test items are cut into windows of ``n`` words (an item with fewer words is one
window).  The corpus is indexed for them in two stored tables of postings
(term, document, position):

1. Counts say how often each test term stands in the corpus; a window with a
   term that no document has cannot occur and goes.  The postings of every
   window's two rarest terms are stored, over all documents.  Their lists are
   intersected with offsets adjusted: a window may start where both lists say.
2. For the documents where that happens the postings of all test terms are
   stored, and the lists of the window's other terms are intersected in the
   same way.  What is left are the exact occurrences.

Proximity matches come from the same two tables: the rarest term's postings name
the documents, and the lists of the others are read around them.

A list is split by document, so a term that is everywhere is no single key.  The
test terms, and the documents of step 2, are broadcast if they number at most
``MAX_TERMS`` and ``MAX_DOCS``, else joined by shuffles.  Documents are told
apart by id and text hash, so rows that are repeated share their result.

Defined results: a null text has no words; an item without words has no window;
a null item id counts as an empty one; items with equal ids are one item; every
document row gives one row; with an empty test set nothing is hit; columns named
like an output are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmill.plans.shared import materialize, small, spread

WINDOW = 10
MAX_TERMS = 500_000
MAX_DOCS = 2_000_000
SALT = 32
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII only take the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAK), "")


def count_words(text: Column) -> Column:
    """Size of :func:`words`: upper and lower case are both word characters here, so nothing is lower-cased."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")).cast("long")


def windows(items: DataFrame, item_id: str, text: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(distinct windows (``nr``, ``phrase``, ``size``), (``nr``, ``item``): the items that have them)."""
    cut = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    cut = cut.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))).alias("at"))
    cut = materialize(cut.select("item", F.slice("w", F.col("at"), n).alias("phrase")).distinct(), "windows")
    phrases = materialize(cut.select("phrase").distinct().select(F.monotonically_increasing_id().alias("nr"), "phrase", F.size("phrase").alias("size")), "phrases")
    return phrases, cut.join(phrases.select("nr", "phrase"), "phrase").select("nr", "item")


def documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(``k1``, ``k2``, ``text``): what tells documents apart, and their texts."""
    return docs.select(F.col(doc_id).alias("k1"), F.xxhash64(F.col(text)).alias("k2"), F.col(text).alias("text"))


def term_counts(corpus: DataFrame, phrases: DataFrame) -> DataFrame:
    """(``term``, ``n``): how often each term of the windows stands in the corpus; terms that don't are left out.

    Words are exploded with ``outer``: a plain explode makes the optimizer add a
    filter for empty arrays, which would cut each text a second time.
    """
    terms = phrases.select(F.explode("phrase").alias("term")).distinct()
    seen = corpus.select(F.explode_outer(words(F.col("text"))).alias("term")).join(small(terms, MAX_TERMS), "term", "left_semi")
    return materialize(seen.groupBy("term").agg(F.count("*").alias("n")), "term-counts")


def anchored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows that may occur, with their ``anchors``: (``n``, ``term``, ``offset``) of the two rarest terms, rarest first."""
    placed = phrases.select("nr", "phrase", "size", F.posexplode("phrase").alias("offset", "term")).join(counts, "term")
    per = placed.groupBy("nr", "phrase", "size").agg(F.count("*").alias("known"), F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("rare"))
    return materialize(per.where(F.col("known") == F.col("size")).select("nr", "phrase", "size", F.slice("rare", 1, 2).alias("anchors")), "anchored")


def postings(corpus: DataFrame, terms: DataFrame, name: str) -> DataFrame:
    """The stored lists (``term``, ``k1``, ``k2``, ``pos``) of some terms, by term and position; a term's list is split by document."""
    at = corpus.select("k1", "k2", F.posexplode_outer(words(F.col("text"))).alias("pos", "term")).join(small(terms, MAX_TERMS), "term", "left_semi")
    return materialize(at.repartition("term", F.pmod("k2", F.lit(SALT))).sortWithinPartitions("term", "k2", "pos"), name)


class Index:
    """The postings of a corpus for a set of windows (of :func:`anchored`)."""

    def __init__(self, corpus: DataFrame, looked_up: DataFrame):
        self.corpus, self.windows = corpus, looked_up
        self.rarest = postings(corpus, looked_up.select(F.explode("anchors").alias("a")).select("a.term").distinct(), "rarest")
        self.terms = looked_up.select(F.explode("phrase").alias("term")).distinct()

    def starts(self, which: int) -> DataFrame:
        """(``nr``, ``size``, ``k1``, ``k2``, ``pos``, ``start``): where windows stand by their rarest (0) or second rarest (1) term."""
        anchor = F.get("anchors", F.lit(which))
        by = self.windows.select("nr", "size", anchor.alias("a")).where("a is not null").select("nr", "size", "a.term", "a.offset")
        return self.rarest.join(by, "term").select("nr", "size", "k1", "k2", "pos", (F.col("pos") - F.col("offset")).alias("start"))

    def lists_in(self, found: DataFrame) -> DataFrame:
        """The postings of all test terms in the documents (``k1``, ``k2``) of ``found``."""
        wanted = small(found.select(F.col("k1").alias("w1"), F.col("k2").alias("w2")).distinct(), MAX_DOCS)
        near = self.corpus.join(wanted, F.col("k1").eqNullSafe(F.col("w1")) & (F.col("k2") == F.col("w2")), "left_semi")
        return postings(near, self.terms, "lists")


def occurrences(index: Index) -> DataFrame:
    """(``k1``, ``k2``, ``start``, ``stop``, ``nr``) of every place where a window stands."""
    key = ["nr", "size", "k1", "k2", "start"]
    both = index.starts(0).select(*key, F.lit(1).alias("by")).unionAll(index.starts(1).select(*key, F.lit(2).alias("by")))
    met = both.groupBy(*key).agg(F.bit_or("by").alias("by")).where(F.col("by") == F.when(F.col("size") == 1, 1).otherwise(3))
    met = materialize(met.select(*key), "met")
    lists = index.lists_in(met.where("size > 2")).withColumnsRenamed({"k1": "p1", "k2": "p2", "term": "p_term", "pos": "p_pos"})
    other = index.windows.select("nr", "anchors", F.posexplode("phrase").alias("offset", "term")).where(~F.exists("anchors", lambda a: a.offset == F.col("offset"))).drop("anchors")
    needed = met.where("size > 2").join(other, "nr").withColumn("pos", F.col("start") + F.col("offset"))
    there = (F.col("k1").eqNullSafe(F.col("p1"))) & (F.col("k2") == F.col("p2")) & (F.col("term") == F.col("p_term")) & (F.col("pos") == F.col("p_pos"))
    whole = needed.join(lists, there, "left_semi").groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") == F.col("size") - 2)
    found = met.where("size <= 2").unionAll(whole.select(*key))
    return found.select("k1", "k2", "start", (F.col("start") + F.col("size")).alias("stop"), "nr")


def proximity(index: Index, slack: int) -> DataFrame:
    """(``k1``, ``k2``, ``start``, ``stop``, ``nr``) where all terms of a window stand within its size plus ``slack`` words, in any order.

    Around each posting of the window's rarest term the first such stretch is
    given; it is shorter where the document is.
    """
    at = materialize(index.starts(0).select("nr", "size", "k1", "k2", "pos"), "around")
    lists = index.lists_in(at).withColumnsRenamed({"k1": "p1", "k2": "p2", "term": "p_term", "pos": "p_pos"})
    terms = index.windows.select("nr", F.explode(F.array_distinct("phrase")).alias("term"), F.size(F.array_distinct("phrase")).alias("n_terms"))
    lengths = index.corpus.select(F.col("k1").alias("l1"), F.col("k2").alias("l2"), count_words(F.col("text")).cast("int").alias("n_words")).distinct()
    near = at.join(lengths, F.col("k1").eqNullSafe(F.col("l1")) & (F.col("k2") == F.col("l2"))).join(terms, "nr")
    reach = F.least(F.col("size") + slack, F.col("n_words"))
    beside = (F.col("k1").eqNullSafe(F.col("p1"))) & (F.col("k2") == F.col("p2")) & (F.col("term") == F.col("p_term")) & (F.abs(F.col("p_pos") - F.col("pos")) < reach)
    # Of at most 2 * reach places around the posting: the first start from which all terms are met.
    key = ["nr", "k1", "k2", "pos", "n_terms", "n_words", reach.alias("reach")]
    seen = near.join(lists, beside).groupBy(*key).agg(F.collect_list(F.struct(F.col("p_pos").alias("at"), "term")).alias("seen"))
    starts = F.sequence(F.greatest(F.col("pos") - F.col("reach") + 1, F.lit(0)), F.greatest(F.least(F.col("pos"), F.col("n_words") - F.col("reach")), F.lit(0)))
    met = lambda i: F.size(F.array_distinct(F.transform(F.filter("seen", lambda x: (x["at"] >= i) & (x["at"] < i + F.col("reach"))), lambda x: x.term)))
    first = seen.withColumn("start", F.get(F.filter(starts, lambda i: met(i) == F.col("n_terms")), F.lit(0))).where("start is not null")
    return first.select("k1", "k2", "start", (F.col("start") + F.col("reach")).alias("stop"), "nr").distinct()


def _covered(spans: Column) -> Column:
    """Number of words in a sorted array of (start, stop)."""
    state = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def add(a: Column, s: Column) -> Column:
        return F.struct(F.greatest(a.upto, s.stop).alias("upto"), (a.n + F.greatest(s.stop - F.greatest(s.start, a.upto), F.lit(0))).alias("n"))

    return F.aggregate(spans, state, add, lambda a: a.n.cast("long"))


def indexed(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, *, n: int = WINDOW) -> tuple[Index, DataFrame]:
    """(the corpus' index for the items' windows, the items (``nr``, ``item``) of each window)."""
    corpus = documents(docs, doc_id, text)
    phrases, having = windows(items, item_id, item_text, n)
    return Index(corpus, anchored(phrases, term_counts(corpus, phrases))), having


def hits(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, *, n: int = WINDOW) -> DataFrame:
    """Per document that has any hit: (``k1``, ``k2``, ``n_hit``, ``items``)."""
    index, having = indexed(docs, doc_id, text, items, item_id, item_text, n=n)
    found = materialize(occurrences(index), "occurrences")
    spans = found.groupBy("k1", "k2").agg(_covered(F.array_sort(F.collect_set(F.struct("start", "stop")))).alias("n_hit"))
    named = found.select("k1", "k2", "nr").distinct().join(having, "nr").groupBy(F.col("k1").alias("i1"), F.col("k2").alias("i2")).agg(F.array_sort(F.collect_set("item")).alias("items"))
    return spans.join(named, F.col("k1").eqNullSafe(F.col("i1")) & (F.col("k2") == F.col("i2"))).select("k1", "k2", "n_hit", "items")


def decontaminate(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, *, carry: list[str] | None = None, n: int = WINDOW) -> DataFrame:
    """Columns ``carry`` (default all) with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    made = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in made]
    found = hits(docs, doc_id, text, items, item_id, item_text, n=n).toDF("__f1", "__f2", "__n_hit", "__items")
    rows = docs.select(*keep, count_words(F.col(text)).alias("n_words"), F.col(doc_id).alias("__k1"), F.xxhash64(F.col(text)).alias("__k2"))
    joined = rows.join(found, F.col("__k1").eqNullSafe(F.col("__f1")) & (F.col("__k2") == F.col("__f2")), "left")
    n_hit = F.coalesce("__n_hit", F.lit(0).cast("long"))
    found_items = F.coalesce("__items", F.array().cast("array<string>"))
    return joined.select(*keep, "n_words", n_hit.alias("n_hit"), F.size(found_items).cast("long").alias("n_items"), F.sha2(F.array_join(found_items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """Words of every document that stand in windows of benchmark items; a null text has no words."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, "doc_id", "text", items, "item_id", "text", carry=["doc_id"])


_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
OP7_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS size, list_slice(w, i0, i0 + {WINDOW - 1}) AS phrase
      FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i0) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM q),
p AS (SELECT doc_id, size, i0, list_slice(w, i0, i0 + size - 1) AS phrase
      FROM d, sizes, LATERAL (SELECT unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS i0)),
m AS (SELECT doc_id, item_id, p.i0, p.size FROM p JOIN q ON p.size = q.size AND p.phrase = q.phrase),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i0, i0 + size)) AS pos FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id, ',' ORDER BY item_id)) AS items_sha256 FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""
