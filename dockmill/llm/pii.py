"""Personal data: patterns, and information-theoretic sanitisation of what reveals it.

Patterns find e-mail addresses, IPv4 addresses, payment cards and phone
numbers.  Each distinct value found is a protected entity.  A word in the same
document can reveal it even when the entity itself is masked; following
C-sanitisation (Sanchez and Batet 2016), corpus counts say how much.  With
document frequencies as probabilities, a term t that documents show together
with entity e, wherever in the text, discloses it if

    PMI(t; e) = log p(t, e) / (p(t) p(e))  >=  disclosure * IC(e) = -disclosure * log p(e)

(at 1 the term alone identifies the entity) and at least ``min_support``
documents show the two together.  Every occurrence of such a term is masked in
each document that holds the entity.  A term is a word between white space, as
written; words that overlap a span are masked with it and don't count.

The texts are searched once; those with an entity go to a table in the shared
folder, equal ones as one row with their number.  All counting and matching are
joins and aggregations, so neither the entities nor the disclosing terms have to
fit anywhere.  Terms that are in too many documents to disclose any entity they
meet are left out before they are paired, which changes no result.

Defined results: a null text is an empty one; every row gives one row, repeated
rows too (each counts as a document); an empty table gives an empty result;
columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmill.plans.shared import materialize, spread

KINDS = ["email", "ip", "card", "phone"]
MIN_SUPPORT = 3
SLICE = 500
DISCLOSURE = 0.95

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")
# A match takes a run of digits whole, so the next one never starts inside a run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(_DOUBLED[int(d)] for d in digits[-2::-2])) % 10 == 0


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in code points, end exclusive; linear in the text."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    if _DIGIT.search(text) is None:
        return found
    for m in _IP.finditer(text):
        if all(len(x := p.lstrip("0")) <= 3 and int(x or "0") <= 255 for p in m.group().split(".")):
            found["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found["phone"].append(m.span())
    return found


def shown(text: str, found: dict[str, list[tuple[int, int]]]) -> dict:
    """Of a text with spans: ``rest``, where words that overlap a span are blanks, the words that are only such, and the entities' hashes."""
    spans = sorted(s for kind in found.values() for s in kind)
    if not spans:
        return {"rest": None, "hidden": None, "entities": None, "group": None}
    parts, taken, at = [], set(), 0
    for a, b in spans:
        if b <= at:
            continue
        start, gap = max(a, at), _SPACE.search(text, b)
        while start > at and not _SPACE.match(text, start - 1):
            start -= 1
        stop = gap.start() if gap else len(text)
        for word in _WORD.finditer(text, start, stop):
            parts += [text[at : word.start()], " " * (word.end() - word.start())]
            taken.add(word.group())
            at = word.end()
    rest = "".join([*parts, text[at:]])
    hidden = sorted(taken.difference(map(re.Match.group, _WORD.finditer(rest))))
    entities = sorted({hashlib.sha256(f"{kind}:{text[a:b].lower()}".encode("utf-8", "replace")).hexdigest()[:32] for kind, own in found.items() for a, b in own})
    group = hashlib.sha256("\n".join([*entities, "", *hidden, "", rest]).encode("utf-8", "replace")).digest()[:16]
    return {"rest": rest, "hidden": hidden, "entities": entities, "group": group}


def _joined(found: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in found[kind])


_SHOWN = {"rest": T.StringType(), "hidden": T.ArrayType(T.StringType()), "entities": T.ArrayType(T.StringType()), "group": T.BinaryType()}
_ARROW = {"rest": pa.string(), "hidden": pa.list_(pa.string()), "entities": pa.list_(pa.string()), "group": pa.binary()}
COUNTS = [f"n_{k}" for k in KINDS]


def search(df: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """Columns ``carry`` of ``df`` with counts by kind, ``base_sha256``, ``base_spans`` and what :func:`shown` gives (``__rest`` and so on)."""
    made = {c: T.LongType() for c in COUNTS} | {"base_sha256": T.StringType(), "base_spans": T.StringType()} | {f"__{k}": v for k, v in _SHOWN.items()}
    rest = [f for f in df.schema.fields if f.name in carry and f.name not in made]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            columns: dict[str, list] = {k: [] for k in made}
            for t in batch.column("__pii_text"):
                t = t.as_py() or ""
                found = find_spans(t)
                for k in KINDS:
                    columns[f"n_{k}"].append(len(found[k]))
                columns["base_spans"].append(joined := _joined(found))
                columns["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                for k, v in shown(t, found).items():
                    columns[f"__{k}"].append(v)
            new = [pa.array(columns[k], pa.int64() if k in COUNTS else _ARROW.get(k[2:], pa.string())) for k in made]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + new, names=[*names, *made])

    schema = T.StructType([*rest, *(T.StructField(k, v) for k, v in made.items())])
    return df.select(*names, F.col(text).alias("__pii_text")).mapInArrow(run, schema)


def _words(text: str) -> Column:
    return F.explode(F.array_distinct(F.split(text, r"[\x20\x09-\x0D]+")))


def disclosing(groups: DataFrame, texts: DataFrame, *, min_support: int, disclosure: float) -> DataFrame:
    """(``group``, ``terms``): of each group with any, the terms that give one of its entities away.

    ``groups``: (group, w, rest, hidden, entities), ``w`` documents that are equal in what is shown;
    ``texts``: one column ``text`` with all documents.
    """
    n = F.lit(float(max(texts.count(), 1)))

    def discloses(n_both: Column, n_term: str, n_entity: str) -> Column:
        pmi = F.log(n_both * n / (F.col(n_term) * F.col(n_entity)))
        return pmi >= disclosure * -F.log(F.col(n_entity) / n)

    def can(n_term: str, n_entity: str) -> Column:  # were the rarer of the two never without the other
        return discloses(F.least(n_term, n_entity), n_term, n_entity)

    held = groups.select("group", "w", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.sum("w").alias("n_entity")).where(F.col("n_entity") >= min_support)
    held = materialize(held.drop("w").join(entities, "entity"), "held")
    most = held.groupBy("group").agg(F.max("n_entity").alias("most"))
    words = groups.join(most, "group").select("group", "w", "most", _words("rest").alias("term")).where("term <> ''")
    # A term is in at least the documents that show it with entities, which rules out common words before the corpus is counted.
    least = words.groupBy("term").agg(F.sum("w").alias("n_least"), F.max("most").alias("most"))
    least = least.where((F.col("n_least") >= min_support) & can("n_least", "most"))
    # Where a word is part of a span only, the document doesn't show it.
    seen = texts.select(_words("text").alias("term"), F.lit(1).cast("long").alias("w")).unionByName(groups.select(F.explode("hidden").alias("term"), F.negate("w").alias("w")))
    counted = seen.groupBy("term").agg(F.sum("w").alias("n_term"))
    terms = materialize(least.join(counted, "term").where(can("n_term", "most")).select("term", "n_term"), "terms")
    rare = words.join(terms, "term").where(can("n_term", "most")).drop("most")
    pairs = materialize(rare.join(held, "group").where(can("n_term", "n_entity")), "pairs")
    together = pairs.groupBy("term", "entity").agg(F.sum("w").alias("n_both"), F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity"))
    bad = together.where((F.col("n_both") >= min_support) & discloses(F.col("n_both"), "n_term", "n_entity")).select("term", "entity")
    return pairs.join(bad, ["term", "entity"], "left_semi").groupBy("group").agg(F.collect_set("term").alias("terms"))


def _places(hit: DataFrame) -> DataFrame:
    """(``__group``, ``__extra``): every place of ``terms`` in ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = []
            for rest, terms in zip(batch.column("rest"), batch.column("terms"), strict=True):
                terms = set(terms.as_py())
                extra.append(",".join(f"term:{m.start()}:{m.end()}" for m in _WORD.finditer(rest.as_py()) if m.group() in terms))
            yield pa.RecordBatch.from_arrays([batch.column("group"), pa.array(extra, pa.string())], names=["__group", "__extra"])

    return hit.select("group", "rest", "terms").mapInArrow(run, "__group binary, __extra string")


def sanitise(df: DataFrame, text: str, carry: list[str], *, min_support: int = MIN_SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """Columns ``carry`` with counts by kind, ``base_sha256``, ``base_spans`` and ``spans``.

    ``spans`` has the base spans and those of disclosing terms (kind ``term``),
    as ``kind:start:end`` in order of kind and start.
    """
    found = materialize(search(df, text, carry).drop("spans"), "found")
    held = found.where("__group is not null")
    first = [F.first(f"__{k}").alias(k) for k in ("rest", "hidden", "entities")]
    groups = materialize(held.groupBy(F.col("__group").alias("group")).agg(F.count("*").alias("w"), *first), "groups")
    hit = disclosing(groups, df.select(F.col(text).alias("text")), min_support=min_support, disclosure=disclosure)
    extra = _places(groups.select("group", "rest").join(hit, "group"))
    made = [f"__{k}" for k in _SHOWN]
    masked = held.join(extra, "__group", "left").withColumn("spans", F.concat_ws(",", "base_spans", "__extra")).drop("__extra", *made)
    return found.where("__group is null").withColumn("spans", F.lit("")).drop(*made).unionByName(masked)


def mask(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets.

    Of spans that overlap, the one that starts first (the longer of two) is
    masked and the others' remainders go with it.
    """
    parsed = F.transform(F.filter(F.split(spans, ","), lambda s: s != ""), lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("start"), (-F.split(s, ":")[2].cast("int")).alias("stop"), F.split(s, ":")[0].alias("kind")))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        stop = F.negate(s.stop)
        fresh = s.start >= a.at
        add = F.array(F.substring(text, a.at + 1, s.start - a.at), F.concat(F.lit("<"), F.upper(s.kind), F.lit(">")))
        return F.struct(F.greatest(a.at, stop).alias("at"), F.when(fresh, F.concat(a.parts, add)).otherwise(a.parts).alias("parts"))

    def finish(a: Column) -> Column:
        return F.concat(F.array_join(a.parts, ""), F.substring(text, a.at + 1, F.length(text)))

    return F.when(F.coalesce(spans, F.lit("")) == "", text).otherwise(F.aggregate(F.array_sort(parsed), state, step, finish))


def op5_pii(spark, sf_dir: str) -> DataFrame:
    """Counts, base spans and all spans of every document; a null text has none."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return sanitise(docs, "text", ["doc_id"]).select("doc_id", *COUNTS, "base_sha256", "spans")
