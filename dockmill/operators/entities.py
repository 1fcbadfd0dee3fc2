"""Dictionary entities: matching terms at word boundaries, frequency band.

A dictionary of up to ``MAX_TERMS`` terms and ``MAX_CHARS`` characters becomes one
Aho-Corasick automaton, built once a worker from a broadcast list, and each text
is read once for all terms.  A larger one is matched by joins: every run of ASCII
word characters in a term is a whole word wherever the term matches, since beside
a word character at its edge there must be none; a term without word characters
has to fill the gap between two words.  So documents' words (and gaps) are joined
with each term's longest word, and only terms whose key a document has are
searched in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD, NOT_WORD = "[A-Za-z0-9_]", "[^A-Za-z0-9_]"
MAX_TERMS = 100_000
MAX_CHARS = 1_000_000


def bounded_pattern(term: Column) -> Column:
    """The regex of :func:`dockmill.functions.text.bounded` for a column of terms."""
    before = F.when(term.rlike(f"^{WORD}"), F.lit(f"(?<!{WORD})")).otherwise(F.lit(f"(?<={WORD})"))
    after = F.when(term.rlike(f"{WORD}$"), F.lit(f"(?!{WORD})")).otherwise(F.lit(f"(?={WORD})"))
    return F.concat(before, F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"), after)


_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


class Terms:
    """An automaton over (category, label, term) rows."""

    def __init__(self, rows: list[tuple[str, str, str]]):
        import ahocorasick

        self.entities = sorted({r[:2] for r in rows}, key=lambda e: (e[0] or "", e[1] or ""))
        number = {e: i for i, e in enumerate(self.entities)}
        of: dict[str, set[int]] = {}
        for category, label, term in rows:
            of.setdefault(term, set()).add(number[category, label])
        self.automaton = ahocorasick.Automaton()
        for term, entities in of.items():
            self.automaton.add_word(term, (len(term), term[0] in _WORD, term[-1] in _WORD, frozenset(entities)))
        self.automaton.make_automaton()

    def find(self, text: str) -> set[int]:
        """The entities one of whose terms stands in the text: a word character at its edge has none beside it, another edge has one."""
        found: set[int] = set()
        last = len(text) - 1
        for end, (size, word_first, word_last, entities) in self.automaton.iter(text) if len(self.automaton) else ():
            if not entities <= found and (end - size >= 0 and text[end - size] in _WORD) != word_first and (end < last and text[end + 1] in _WORD) != word_last:
                found |= entities
        return found


_terms: dict[int, Terms] = {}  # the last broadcast list's automaton, in a worker


def _by_automaton(rows: DataFrame, terms: list[tuple[str, str, str]]) -> DataFrame:
    """(``d``, ``category``, ``label``) of ``rows`` (``d``, ``t``)."""
    shared = rows.sparkSession.sparkContext.broadcast(terms)  # MAX_TERMS and MAX_CHARS at most
    schema = T.StructType([rows.schema["d"], T.StructField("category", T.StringType()), T.StructField("label", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        if id(listed) not in _terms:
            _terms.clear()
            _terms[id(listed)] = Terms(listed)
        known = _terms[id(listed)]
        for batch in batches:
            hits = [(i, e) for i, text in enumerate(batch.column("t").to_pylist()) if text for e in known.find(text)]
            names = [known.entities[e] for _, e in hits]
            columns = [batch.column("d").take(pa.array([i for i, _ in hits], pa.int64())), *(pa.array([n[k] for n in names], pa.string()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "category", "label"])

    return rows.mapInArrow(run, schema)


def annotate(docs: DataFrame, doc_id: str, text: str, dictionary: DataFrame) -> DataFrame:
    """Distinct (``doc_id``, ``category``, ``label``) of entities one of whose terms stands in the text.

    ``dictionary``: (``category``, ``label``, ``terms``).  Case counts; each text
    is searched afresh, whatever was found in others.
    """
    terms = dictionary.select("category", "label", F.explode("terms").alias("term")).where("term <> ''").distinct()
    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t"))
    n_terms, n_chars = terms.agg(F.count("*"), F.coalesce(F.sum(F.length("term")), F.lit(0))).first()
    if n_terms <= MAX_TERMS and n_chars <= MAX_CHARS:
        found = _by_automaton(rows, [tuple(r) for r in terms.collect()])
        return found.select(F.col("d").alias(doc_id), "category", "label").distinct()
    runs = F.filter(F.split("term", f"{NOT_WORD}+"), lambda w: w != "")
    longest = F.array_max(F.transform(runs, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))).w
    terms = terms.select("category", "label", "term", F.coalesce(longest, F.col("term")).alias("key"), bounded_pattern(F.col("term")).alias("pattern"))
    words = F.filter(F.split(F.col("t"), f"{NOT_WORD}+"), lambda w: w != "")
    if terms.where(~F.col("term").rlike(WORD)).limit(1).count():
        gaps = F.split(F.col("t"), f"{WORD}+")
        words = F.concat(words, F.slice(gaps, 2, F.greatest(F.size(gaps) - 2, F.lit(0))))
    keyed = F.explode_outer(F.array_distinct(words)).alias("key")
    # A term that is its own key is decided by the join; others by a plain search first, then at the boundaries.
    stands = (F.col("term") == F.col("key")) | (F.contains("t", "term") & F.regexp("t", F.col("pattern")))
    near = rows.select("d", keyed).join(terms, "key").select("d", "category", "label", "term", "key", "pattern")
    found = near.join(rows.withColumnRenamed("d", "__d"), F.col("d").eqNullSafe(F.col("__d"))).where(stands)
    return found.select(F.col("d").alias(doc_id), "category", "label").distinct()


def frequency_band(mentions: DataFrame, doc_id: str, total: DataFrame) -> DataFrame:
    """Entities found in at least 1 % (and one) and at most half of the documents.

    ``total``: one row with ``n``, the number of documents.
    """
    hits = mentions.groupBy("category", "label").agg(F.countDistinct(doc_id).alias("hits"))
    banded = hits.crossJoin(total.select("n"))  # one row on the right
    return banded.where((F.col("hits") >= F.greatest(F.lit(1), F.floor(F.col("n") * 0.01))) & (F.col("hits") <= F.floor(F.col("n") * 0.5))).select("category", "label", "hits")


def with_definitions(taxonomy: DataFrame) -> DataFrame:
    """Blank definitions get a default; others stay as they are."""
    blank = F.coalesce(F.trim("definition"), F.lit("")) == ""
    return taxonomy.withColumn("definition", F.when(blank, F.concat(F.lit("References to "), F.col("label"))).otherwise(F.col("definition")))


def other_terms(terms: Column, label: Column) -> Column:
    return F.array_remove(terms, label)
