"""Phrases whose words keep together, mined from position bitmaps per word.

Texts are cut into shards (:mod:`dockmill.llm.shards`) whose positions are numbered
through, with an empty one between pieces and in place of words that are too rare
for any phrase.  In a shard each word has a bitmap of its positions, compressed to
the bytes that are not zero.  A phrase's bitmap says where its last word stands:
shifted by one and ANDed with the bitmaps of all words it becomes those of the
longer phrases, whose popcounts are the counts in the shard.  Shards are gone
through depth-first, a run of first words at a time.  Counts are summed
over shards in parts:

1. Words, by a join; those with fewer than ``least`` occurrences leave the bitmaps.
2. Pairs.  Their sums tell each shard which of its pairs are frequent.
3. Phrases of three and four words all of whose pairs are frequent, depth-first.

A longer phrase is no more frequent than its parts, so nothing is lost by that,
and all counts are exact.  What follows works on frequent phrases only.

Defined results: a null text has no words; a null language is ``und``; repeated rows
count each time; an empty table, or one without frequent phrases, gives no rows.
A text of any length is cut between words, and the shards it is in share the
words at the cut, which start phrases in one of them only.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.llm import shards
from dockmill.llm.shards import ASKED, ASKED_ARROW, Numbers, added, asked, by_shard, deal, dense_ids, segments, table, width
from dockmill.plans.ordering import numbered
from dockmill.plans.shared import materialize, small, spread

LEAST = 30
LONGEST = 4
TOP = 2000
MAX_LANGUAGES = 100_000  # rows that are broadcast; more are joined by a shuffle
ROWS = 300_000  # bytes of bitmaps that are extended at once

#: A-Z lower-cased, tabs as blanks, ends of pieces as line feeds.
FOLD = bytes(32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))

SHARDS = "shard long, lang string, word binary, local int, n long, n_start int, places binary"
_SHARDS_ARROW = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("local", pa.int32()), ("n", pa.int64()), ("n_start", pa.int32()), ("places", pa.binary())])


class Cutter:
    """Fills shards with the pieces of texts; words have numbers by language, 0 is no word."""

    def __init__(self, first: int):
        self.shard = first - 1
        self._open()

    def _open(self) -> None:
        self.shard += 1
        self.count, self.numbers, self.places, self.size = itertools.count(1), {}, [], 0

    def _put(self, lang: str, tokens: list[bytes]) -> None:
        if (ids := self.numbers.get(lang)) is None:
            ids = self.numbers[lang] = Numbers({b"": -1, b"\n": 0}, self.count)
        x = np.fromiter(map(ids.__getitem__, tokens), dtype=np.int32, count=len(tokens))
        self.places.append(x[x >= 0])
        self.size += len(self.places[-1])

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        end: list[bytes] = []  # the last words
        for segment in segments(text.translate(FOLD).replace(b"\n", b" \n ")):
            self._put(lang, tokens := segment.split(b" "))
            end = [*end, *reversed([*itertools.islice(filter(None, reversed(tokens)), LONGEST - 1)])][1 - LONGEST :]
            if self.size >= shards.SHARD:
                yield from self.close(len(end))
                self._put(lang, end)
        self.places.append(np.zeros(1, dtype=np.int32))
        self.size += 1
        if self.size >= shards.SHARD:
            yield from self.close()

    def close(self, shared: int = 0) -> Iterator[pa.RecordBatch]:
        """The shard's rows; the last ``shared`` positions begin the next one."""
        if self.size:
            places = np.concatenate(self.places)
            n = np.bincount(places[: self.size - shared], minlength=next(self.count))
            for lang, ids in self.numbers.items():
                words = [w for w, i in ids.items() if i > 0]
                local = np.fromiter((i for i in ids.values() if i > 0), dtype=np.int32, count=len(words))
                k = len(words)
                yield from pa.Table.from_arrays([pa.array([self.shard] * k, pa.int64()), pa.array([lang] * k, pa.string()), pa.array(words, pa.binary()), pa.array(local), pa.array(n[local], pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], schema=_SHARDS_ARROW).to_batches(50_000)
            yield from table([(self.shard, None, None, None, None, self.size - shared, places.tobytes())], _SHARDS_ARROW).to_batches()
        self._open()


def cut(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """The shards of a corpus: rows of words (``lang``, ``word``, ``local``, ``n``) and rows of ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cutter = Cutter(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                if raw := text.as_py():
                    yield from cutter.add(lang, raw)
        yield from cutter.close()

    typed = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    return typed.mapInArrow(run, SHARDS)


# ---------------------------------------------------------------- bitmaps of a shard


@dataclass
class Bitmaps:
    """Rows (``of``, ``block``, ``mask``), by ``of``: byte ``block`` of the bitmap of ``of``; bytes without a bit are left out."""

    of: np.ndarray
    block: np.ndarray
    mask: np.ndarray

    @classmethod
    def of_words(cls, x: np.ndarray) -> Bitmaps:
        at = np.flatnonzero(x)
        at = at[np.argsort(x[at], kind="stable")]
        word, block = x[at], (at >> 3).astype(np.int32)
        first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (block[1:] != block[:-1])])) if len(at) else at
        bit = np.left_shift(1, at & 7).astype(np.uint8)
        return cls(word[first], block[first], np.bitwise_or.reduceat(bit, first) if len(first) else bit)

    def rows(self, keep: np.ndarray | slice) -> Bitmaps:
        return Bitmaps(self.of[keep], self.block[keep], self.mask[keep])

    def shifted(self) -> Bitmaps:
        """Every bit one position on; a byte's last bit is carried to the next byte."""
        inside, carry = (self.mask << 1).astype(np.uint8), self.mask >> 7
        a, b = inside != 0, carry != 0
        return Bitmaps(np.concatenate([self.of[a], self.of[b]]), np.concatenate([self.block[a], self.block[b] + 1]), np.concatenate([inside[a], carry[b]]))


class Shard:
    """The bitmaps of a shard's words; ``n_start`` is where phrases no longer start."""

    def __init__(self, x: np.ndarray, n_start: int):
        words = Bitmaps.of_words(x)
        order = np.argsort(words.block, kind="stable")
        self.words = words.rows(order)  # by block
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(words.block, minlength=(len(x) >> 3) + 2))])
        self.every, self.starts = words, words if n_start == len(x) else Bitmaps.of_words(x[:n_start])
        self.base = np.int64(x.max(initial=0) + 1)
        self.end = x[n_start:].tolist()

    def extend(self, phrases: Bitmaps) -> tuple[np.ndarray, Bitmaps]:
        """The phrases' bitmaps shifted and ANDed with those of all words: (the added word by row, the rows)."""
        at = phrases.shifted()
        n = self.begin[at.block + 1] - self.begin[at.block]
        row = np.repeat(np.arange(len(n)), n)
        word = np.arange(len(row)) + np.repeat(self.begin[at.block] - (np.cumsum(n) - n), n)
        met = at.mask[row] & self.words.mask[word]
        hit = np.flatnonzero(met)
        row = row[hit]
        return self.words.of[word[hit]], Bitmaps(at.of[row], at.block[row], met[hit])

    def grown(self, phrases: Bitmaps, last: np.ndarray | None, alive: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, Bitmaps]:
        """(phrase, added word, popcount) of all longer phrases, by both, and their bitmaps by place in that list.

        ``last``: each phrase's last word, if not the phrase itself; ``alive``: the
        frequent pairs, if only phrases with such at their end are wanted.
        """
        word, rows = self.extend(phrases)
        if alive is not None:
            pair = (rows.of if last is None else last[rows.of]) * self.base + word
            keep = np.flatnonzero(alive[np.minimum(np.searchsorted(alive, pair), len(alive) - 1)] == pair) if len(alive) else np.zeros(0, np.int64)
            word, rows = word[keep], rows.rows(keep)
        key = rows.of * self.base + word
        order = np.argsort(key, kind="stable")
        key, rows = key[order], rows.rows(order)
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        n = np.add.reduceat(np.bitwise_count(rows.mask).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        return (key[first] // self.base).astype(np.int32), (key[first] % self.base).astype(np.int32), n, Bitmaps(np.cumsum(new, dtype=np.int32) - 1, rows.block, rows.mask)

    @staticmethod
    def runs(words: Bitmaps) -> Iterator[Bitmaps]:
        """The bitmaps of some words at a time."""
        border = np.flatnonzero(np.concatenate([[True], words.of[1:] != words.of[:-1], [True]])) if len(words.of) else []
        at = 0
        for b in [*border[1:]]:
            if b - at >= ROWS or b == len(words.of):
                yield words.rows(slice(at, b))
                at = b

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, second word, count), by both; with 0 those of which the next shard counts all."""
        found = [self.grown(r, None, None)[:3] for r in self.runs(self.every)]
        a, b, n = (np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64) for j in range(3))
        for x, y in itertools.pairwise(self.end):
            if x and y:
                n[np.searchsorted(a * self.base + b, x * self.base + y)] -= 1  # pairs are in order
        return a, b, n

    def longer(self, alive: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """(the words by place, 0 beyond the last; counts) of phrases of three words and more with frequent pairs only."""
        for first in self.runs(self.starts):
            phrases, words, last = first, None, None
            for size in range(2, LONGEST + 1):
                of, word, n, phrases = self.grown(phrases, last, alive)
                words = [of, word] if words is None else [*(w[of] for w in words), word]
                last = word
                if size > 2 and len(n):
                    yield words + [np.zeros(len(n), np.int64)] * (LONGEST - size), n


# ---------------------------------------------------------------- counts over all shards


def _numbered(known: pa.Table, body: pa.Table) -> pa.Table:
    """A shard's positions with the local numbers of frequent words only, counted from 1, and these words' numbers in the corpus."""
    out = pa.schema([("shard", pa.int64()), ("n_start", pa.int32()), ("places", pa.binary()), ("ids", pa.binary())])
    if not body.num_rows or not known.num_rows:
        return out.empty_table()
    places = np.frombuffer(body.column("places")[0].as_py(), dtype=np.int32)
    local, ids = known.column("local").to_numpy(), known.column("id").to_numpy()
    order = np.argsort(local)
    to = np.zeros(int(max(places.max(initial=0), local.max())) + 1, dtype=np.int32)
    to[local[order]] = np.arange(1, len(local) + 1)
    return table([(body.column("shard")[0].as_py(), body.column("n_start")[0].as_py(), to[places].tobytes(), ids[order].astype(np.int64).tobytes())], out)


def _of(shard: int, n_start: int, places: bytes, ids: bytes) -> tuple[int, Shard, np.ndarray]:
    return shard, Shard(np.frombuffer(places, dtype=np.int32), n_start), np.concatenate([[0], np.frombuffer(ids, dtype=np.int64)])


def phrases(docs: DataFrame, lang: str, text: str, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words (``id``, ``lang``, ``word``, ``f``), phrases (``p``: words' ids, ``f``), languages (``lang``, ``n``)), all with ``f >= least``."""
    corpus = materialize(cut(docs, lang, text), "phrase-shards")
    listed = corpus.where("word is not null")
    totals = listed.groupBy("lang").agg(F.sum("n").alias("n"))
    words = dense_ids(listed.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "phrase-words")
    known = listed.join(words, ["lang", "word"]).select("shard", "local", "id")
    body = corpus.where("places is not null").select("shard", "n_start", "places")
    bitmaps = materialize(by_shard(known, body, _numbered, "shard long, n_start int, places binary, ids binary"), "phrase-places")

    n_words, n_tokens = words.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    form, parts = width(n_words), max(1, -(-n_tokens // shards.PART))

    def ask(body: pa.Table) -> pa.Table:
        number, shard, ids = _of(*(body.column(c)[0].as_py() for c in ("shard", "n_start", "places", "ids")))
        a, b, n = shard.pairs()
        return table(asked(number, [ids[a], ids[b]], n, parts, form), ASKED_ARROW)

    def answer(rows: pa.Table) -> pa.Table:
        """Frequent pairs with their sums, and to each shard a bit for each of its keys."""
        (a, b), f, place, begin = added(rows, 2, form)
        good, part = f >= least, rows.column("part")[0].as_py()
        told = [(s, part, np.packbits(good[place[x:y]]).tobytes(), None, None) for s, x, y in zip(rows.column("shard").to_pylist(), begin, begin[1:], strict=False)]
        return table(told + [(None, None, None, [int(x), int(y)], int(n)) for x, y, n in zip(a[good], b[good], f[good], strict=True)], pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("bits", pa.binary()), ("p", pa.list_(pa.int64())), ("f", pa.int64())]))

    pairs = materialize(bitmaps.groupBy("shard").applyInArrow(ask, ASKED).groupBy("part").applyInArrow(answer, "shard long, part int, bits binary, p array<long>, f long"), "phrase-pairs")

    def ask_longer(told: pa.Table, body: pa.Table) -> pa.Table:
        if not body.num_rows or not told.num_rows:
            return ASKED_ARROW.empty_table()
        number, shard, ids = _of(*(body.column(c)[0].as_py() for c in ("shard", "n_start", "places", "ids")))
        a, b, _ = shard.pairs()
        order, begin = deal([ids[a], ids[b]], parts)
        good = np.zeros(len(a), dtype=bool)
        for p, bits in zip(told.column("part").to_pylist(), told.column("bits").to_pylist(), strict=True):
            own = order[begin[p] : begin[p + 1]]
            good[own] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=len(own)).astype(bool)
        found = [(asked(number, [ids[w] for w in words], n, parts, form)) for words, n in shard.longer((a * shard.base + b)[good])]
        return table([r for rows in found for r in rows], ASKED_ARROW)

    def total(rows: pa.Table) -> pa.Table:
        columns, f, _, _ = added(rows, LONGEST, form)
        good = f >= least
        p = [[int(w) for w in ws if w] for ws in zip(*(c[good] for c in columns), strict=True)]
        return pa.table({"p": pa.array(p, pa.list_(pa.int64())), "f": pa.array(f[good])})

    told = pairs.where("bits is not null").select("shard", "part", "bits")
    longer = by_shard(told, bitmaps, ask_longer, ASKED).groupBy("part").applyInArrow(total, "p array<long>, f long")
    return words, materialize(pairs.where("p is not null").select("p", "f").unionAll(longer), "phrases"), totals


def collocations(docs: DataFrame, lang: str, text: str, *, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases by score: (``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``)."""
    words, found, totals = phrases(docs, lang, text, least)
    size = F.size("p")
    # A longer phrase that takes a shorter one in at four fifths has one in between that does, so one word more is enough to look at.
    inside = found.where(size > 2).select(F.explode(F.array(F.slice("p", F.lit(1), size - 1), F.slice("p", F.lit(2), size - 1))).alias("p"), F.col("f").alias("over"))
    over = inside.groupBy("p").agg(F.max("over").alias("over"))
    left = found.join(over, "p", "left").where(F.col("over").isNull() | (5 * F.col("over") < 4 * F.col("f"))).select("p", F.col("f").alias("a"))
    counts = found.unionAll(words.select(F.array("id").alias("p"), "f"))
    cuts = left.select("p", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("p", F.lit(1), F.col("k")), "rest": F.slice("p", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(counts.select(F.col("p").alias("head"), F.col("f").alias("l")), "head").join(counts.select(F.col("p").alias("rest"), F.col("f").alias("r")), "rest")
    exact = F.expr("cast(2000000 as decimal(19, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    best = cuts.groupBy("p", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("best")).select("p", "a", "best.l", "best.r", "best.score")
    spelt = best.select("*", F.posexplode("p").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    named = spelt.groupBy("p", "a", "l", "r", "score", "lang").agg(F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("w"))
    named = named.withColumn("phrase", F.array_join("w.word", " "))
    # Numbered through all languages, so that a large one is no single task; a language's ranks count from its first number.
    ranked = numbered(named.drop("p", "w"), "at", "lang", F.col("score").desc(), F.col("a").desc(), "phrase")
    first = ranked.groupBy("lang").agg(F.min("at").alias("first")).join(totals, "lang")
    return ranked.join(small(first, MAX_LANGUAGES), "lang").withColumn("rank", F.col("at") - F.col("first") + 1).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """The 2000 phrases of two to four words of each language that keep together best; a null text has no words."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))
    return collocations(docs, "lang", "text")


OP11_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, k, array_to_string(list_slice(w, i0, i0 + k - 1), ' ') AS phrase
      FROM s, (SELECT unnest([1, 2, 3, 4]) AS k), LATERAL (SELECT unnest(range(1, greatest(len(w) - k + 1, 0) + 1)) AS i0)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inside AS (SELECT c.lang, array_to_string(list_slice(w, i0, i0 + m - 1), ' ') AS phrase, max(a) AS over
           FROM c, (SELECT unnest([2, 3]) AS m), LATERAL (SELECT unnest(range(1, greatest(k - m + 1, 0) + 1)) AS i0) WHERE m < k GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE over IS NULL OR 100 * over < 80 * a),
cuts AS (SELECT c.lang, c.phrase, c.a, h.a AS l, r.a AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (h.a + r.a) AS BIGINT) AS score, j
         FROM kept c, LATERAL (SELECT unnest(range(1, c.k)) AS j)
         JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(list_slice(w, 1, j), ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(w, j + 1, c.k), ' ')),
best AS (SELECT lang, phrase, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) JOIN n USING (lang) WHERE rank <= {TOP}
"""
