"""Importance resampling towards a target's distribution, over hashed word n-grams.

Features are the runs of one to three consecutive words; a feature's bucket is
the CRC-32 of its bytes modulo ``BUCKETS``.  A bucket's gain compares how often
the target and the corpus fall into it, a document's weight is the sum over its
features, and documents are drawn without replacement by Gumbel noise that only
their id decides.

Buckets come from an automaton over the Arrow buffer of the texts, a window of
bytes at a time and never a word at a time: a lookup table classifies and
lower-cases the bytes, differences of neighbours give the words' borders, and the
CRC registers of all starts advance together, a byte a step, sorted by length so
that those still running are a prefix.  A register after one word goes on with a
blank and the next word, which gives the runs of two and three words.

The corpus is read twice.  What leaves it are one count a bucket (``BUCKETS`` rows
in all on the driver) and one row of numbers a document.

Defined results: a null text has no words and weight 0; a null id draws the noise
of an empty one; every row of the input gives one row, repeated rows too; among
equal scores and ids the order is any; with an empty target or corpus the counts
are 0; in a table with fewer than 20 documents of 20 words none is drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmill.plans.ordering import numbered
from dockmill.plans.shared import materialize, spread

BUCKETS = 10_000
RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
WINDOW = 1 << 21  # bytes whose words are hashed together
STEPS = 48  # bytes of a word that all registers take together; what longer words have beyond goes one by one


def _classes() -> np.ndarray:
    """Byte to its lower-case form, or to 0 where it is no part of a word."""
    b = np.arange(256, dtype=np.uint8)
    low = np.where((b >= 0x41) & (b <= 0x5A), b + 32, b)
    word = (low >= 0x80) | ((low >= 0x30) & (low <= 0x39)) | ((low >= 0x61) & (low <= 0x7A))
    return np.where(word, low, 0).astype(np.uint8)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CLASSES, CRC = _classes(), _crc_table()
_FULL = np.uint32(0xFFFFFFFF)


def _step(register: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return CRC[(register ^ byte) & 0xFF] ^ (register >> 8)


def advance(register: np.ndarray, low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Registers after the bytes ``low[start:start + size]``, each its own; ``size`` descends."""
    register = register.copy()
    running = np.searchsorted(-size, -np.arange(min(STEPS, int(size[0]) if len(size) else 0)), side="left")
    for j, n in enumerate(running):
        register[:n] = _step(register[:n], low[start[:n] + j])
    for i in range(int(np.searchsorted(-size, -STEPS, side="left"))):
        rest = low[start[i] + STEPS : start[i] + size[i]]
        register[i] = zlib.crc32(rest, int(register[i] ^ _FULL)) ^ 0xFFFFFFFF
    return register


def borders(low: np.ndarray, at: np.ndarray, begin: int, end: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words that start in ``[begin, end)`` and of the ``more`` words after them.

    ``at``: where texts begin; no word goes from one into the next.
    """
    reach = 4096
    while True:
        stop = min(len(low), end + reach)
        word = low[begin:stop] != 0
        first = np.zeros(len(word) + 1, dtype=bool)  # a text begins here
        first[at[np.searchsorted(at, begin) : np.searchsorted(at, stop, side="right")] - begin] = True
        before = np.empty_like(word)
        before[:1], before[1:] = begin > 0 and low[begin - 1] != 0, word[:-1]
        after = np.empty_like(word)
        after[-1:], after[:-1] = stop < len(low) and low[stop] != 0, word[1:]
        starts = np.flatnonzero(word & (~before | first[:-1])) + begin
        ends = np.flatnonzero(word & (~after | first[1:])) + begin + 1
        if len(ends) and (not len(starts) or ends[0] <= starts[0]):
            ends = ends[1:]  # of a word that started before
        own = int(np.searchsorted(starts, end))
        if stop == len(low) or len(ends) >= own + more:
            return starts[: min(len(ends), own + more)], ends[: own + more]
        reach *= 8


def hashed(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By window of bytes: (the document of each word, the document of each feature, the feature's CRC)."""
    texts = texts.fill_null("")
    buffer = texts.buffers()
    at = np.frombuffer(buffer[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(buffer[2], dtype=np.uint8)[at[0] : at[-1]] if buffer[2] is not None else np.zeros(0, np.uint8)
    at, low = at - at[0], CLASSES[raw]
    for begin in range(0, len(low), WINDOW):
        end = min(len(low), begin + WINDOW)
        start, stop = borders(low, at, begin, end, RUN - 1)
        own = int(np.searchsorted(start, end))
        if not own:
            continue
        doc, size = np.searchsorted(at, start, side="right") - 1, stop - start
        by_size = np.argsort(-size, kind="stable")
        register, owner, crc = np.full(len(start), _FULL), [], []
        for k in range(RUN):
            # Feature i goes on with word i + k, if that stands in the same document.
            word = by_size[by_size >= k]
            word = word[(doc[word - k] == doc[word]) & (word - k < own)]
            before = register[word - k]
            register[word - k] = after = advance(_step(before, 0x20) if k else before, low, start[word], size[word])
            owner.append(doc[word - k])
            crc.append(after ^ _FULL)
        yield doc[:own], np.concatenate(owner), np.concatenate(crc)


def _texts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(text)


def bucket_counts(df: DataFrame, text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, dtype=np.int64)
        for _, texts in _texts(batches, "__text"):
            for _, _, crc in hashed(texts):
                n += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(n[seen])], names=["bucket", "n"])

    counted = df.select(F.col(text).alias("__text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for b, n in counted.collect():  # a row a bucket at most
        out[b] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of the two smoothed shares, rounded down."""
    S, T_ = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (S + buckets) / ((s + 1.0) * (T_ + buckets)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weigh(df: DataFrame, text: str, gain: np.ndarray) -> DataFrame:
    """``df`` without its text and with ``n_words``, ``n_features`` and ``weight``."""
    made = ["n_words", "n_features", "weight"]
    rest = [f for f in df.schema.fields if f.name != text and f.name not in made]
    names = [f.name for f in rest]
    shared = df.sparkSession.sparkContext.broadcast(gain)  # a number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, n_buckets = shared.value.astype(np.float64), np.uint32(len(shared.value))
        for batch, texts in _texts(batches, "__text"):
            size = batch.num_rows
            words, features, weight = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
            for of_word, owner, crc in hashed(texts):
                words += np.bincount(of_word, minlength=size)
                features += np.bincount(owner, minlength=size)
                weight += np.bincount(owner, weights=gain[crc % n_buckets], minlength=size).astype(np.int64)  # whole numbers, exact
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, (words, features, weight))], names=[*names, *made])

    return df.select(*names, F.col(text).alias("__text")).mapInArrow(run, T.StructType([*rest, *(T.StructField(k, T.LongType()) for k in made)]))


def resample(docs: DataFrame, doc_id: str, text: str, target: DataFrame, target_text: str, *, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Per document (``doc_id``, ``n_features``, ``weight``, ``score``, ``rank``): of those with ``min_words`` words, ``percent`` in a hundred have a rank."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gain = gains(bucket_counts(docs, "text", buckets), bucket_counts(target, target_text, buckets), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")
    scored = materialize(weigh(docs, "text", gain).withColumn("score", F.col("weight") + noise), "importance")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    ranked = numbered(able, "rank", F.col("score").desc(), F.col("doc_id").asc(), start=1)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    out = ranked.withColumn("rank", rank).unionByName(scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_importance(spark, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document for a draw that resembles ``benchmark``; a null text has no features."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return resample(docs, "doc_id", "text", spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "text")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_RUNS = "list_concat(w, list_transform(range(1, len(w)), lambda i: concat_ws(' ', w[i], w[i + 1])), list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2])))"
OP13_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b::BIGINT)) AS t),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
df AS (SELECT doc_id, unnest({_RUNS}) AS f FROM d),
bf AS (SELECT unnest({_RUNS}) AS f FROM b),
x AS (SELECT f, xor(list_reduce(list_transform(regexp_extract_all(hex(f), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) % {BUCKETS} AS bucket
      FROM (SELECT f FROM df UNION SELECT f FROM bf), crc),
s AS (SELECT bucket, count(*) AS s FROM df JOIN x USING (f) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN x USING (f) GROUP BY 1),
g AS (SELECT k.bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT count(*) FROM df)::DOUBLE + {BUCKETS}) / ((coalesce(s, 0)::DOUBLE + 1) * ((SELECT count(*) FROM bf)::DOUBLE + {BUCKETS}))))::BIGINT AS gain
      FROM (SELECT DISTINCT bucket FROM x) k LEFT JOIN s ON s.bucket = k.bucket LEFT JOIN t ON t.bucket = k.bucket),
w AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM df JOIN x USING (f) JOIN g USING (bucket) GROUP BY 1),
p AS (SELECT d.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || d.doc_id)[1:8])::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN w ON w.doc_id = d.doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM p WHERE n_words >= {MIN_WORDS})
SELECT p.doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * n // 100 THEN rank END AS rank FROM p LEFT JOIN r ON r.doc_id = p.doc_id
"""
