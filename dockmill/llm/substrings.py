"""Substring dedup: suffix automata of earlier documents, matching statistics, maximal spans.

Words of a document that lie in a window of ``n`` words which an earlier
document (smaller id) has too are removed.  Two steps:

1. Candidates.  Window hashes are dealt to shards by hash; per hash the earliest
   document is the reference of the others.  A batch of documents sends each
   hash once and settles its own repeats, so a window that a third of all
   documents share costs a row per batch.  Shards hold some ``SHARD_BYTES``
   however large the corpus is, and a task settles one at a time.  The result
   is pairs of a document and a reference, a few per document with repeats.
2. Automata.  A reference's text goes to the tasks that hold its documents, as a
   suffix automaton over words that is built once and kept for the next pairs.
   A document is streamed through it: the matching statistics (length of the
   longest suffix read that occurs in the reference) give all maximal common
   spans, and those of ``n`` words or more are removed.

References are delivered by a join rather than broadcast to every executor: what
a broadcast would carry grows with the corpus.  Hashes only choose references;
what is removed is decided on the words.  A hash has 96 bits: of 10**13 windows
no two different ones are expected to share one (6e-4), and if they did, only a
repeat that shares no other window with its reference could be missed.

Defined results: a null text has no words; a null id counts as later than all
others; rows with equal ids are not earlier than each other; every row gives one
row; an empty table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmill.llm.memo import only, register
from dockmill.plans.ordering import numbered
from dockmill.plans.shared import discard, materialize, spread

WINDOW = 13
BATCH_WORDS = 400_000
MEMO_WORDS = 600_000
AUTOMATA_WORDS = 150_000
SHARD_BYTES = 4 << 20
PART_SHARDS = 8
MAX_PARTS = 100_000
LAST = 2**63 - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


class Automaton:
    """Suffix automaton of a list of words."""

    def __init__(self, words: list[bytes]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        last = 0
        for w in words:
            last = self._add(last, w)

    def _add(self, last: int, w: bytes) -> int:
        nxt, link, size = self.next, self.link, self.size
        new = len(nxt)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(nxt[q].copy())
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = copy
                    p = link[p]
                link[q] = link[new] = copy
        return new

    def spans(self, words: list[bytes], n: int) -> list[tuple[int, int]]:
        """Maximal stretches of ``words`` made of common substrings of ``n`` words or more."""
        nxt, link, size = self.next, self.link, self.size
        state = length = 0
        out: list[list[int]] = []
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = nxt[state].get(w)
            if to is None:
                length = 0
                continue
            state, length = to, length + 1
            if length >= n:
                start = i + 1 - length
                if out and start <= out[-1][1]:
                    out[-1][1] = i + 1
                else:
                    out.append([start, i + 1])
        return [(a, b) for a, b in out]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()
register("substrings", _hashes.clear)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(n: int, salt: int) -> np.ndarray:
    return _mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


Hashes = tuple[np.ndarray, np.ndarray]  # 64 bits and 32 more


def window_hashes(texts: list[list[bytes]], ids: np.ndarray, n: int) -> tuple[Hashes, np.ndarray]:
    """Hashes of all windows and the ids of their documents."""
    sizes = np.array([len(t) for t in texts])
    total = int(sizes.sum())
    if total < n:
        return (np.empty(0, np.uint64), np.empty(0, np.uint32)), np.empty(0, np.int64)
    words = np.fromiter((_hashes[w] for t in texts for w in t), np.uint64, total)
    upper = (words >> np.uint64(32)).astype(np.uint32)
    sums, more = np.zeros(total - n + 1, np.uint64), np.zeros(total - n + 1, np.uint32)
    for j, (f, g) in enumerate(zip(_factors(n, 0), _factors(n, 1).astype(np.uint32), strict=True)):
        sums += words[j : total - n + 1 + j] * f
        more += upper[j : total - n + 1 + j] * g
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[: total - n + 1] == owner[n - 1 :]
    return (_mix(sums[inside]), more[inside]), ids[owner[: total - n + 1][inside]]


def settle(hashes: Hashes, docs: np.ndarray) -> tuple[Hashes, np.ndarray, np.ndarray]:
    """Per hash its earliest document: (hashes, documents, pairs of a later document and it)."""
    order = np.argsort(docs, kind="stable")
    order = order[np.argsort(hashes[0][order], kind="stable")]
    high, low, docs = hashes[0][order], hashes[1][order], docs[order]
    if ((high[1:] == high[:-1]) & (low[1:] != low[:-1])).any():  # rare: order by all 96 bits
        order = np.lexsort((docs, low, high))
        high, low, docs = high[order], low[order], docs[order]
    first = np.ones(len(high), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    earliest = docs[first][np.cumsum(first) - 1] if len(docs) else docs
    later = docs > earliest
    pairs = np.unique(np.stack([docs[later], earliest[later]], axis=1), axis=0)
    return (high[first], low[first]), docs[first], pairs


def packed(ids: np.ndarray) -> bytes:
    """Ids in order: the first, then the steps from each to the next in as few bytes as the largest needs."""
    steps = np.diff(ids).view(np.uint64)
    width = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(steps) or int(steps.max()) <= np.iinfo(t).max)
    return ids[:1].tobytes() + bytes([np.dtype(width).itemsize]) + steps.astype(width).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, f"u{data[8]}", offset=9).astype(np.int64)
    return np.concatenate([np.frombuffer(data, np.int64, 1), steps]).cumsum()


def _pairs(docs: DataFrame, n: int) -> DataFrame:
    """Distinct (``doc``, ``ref``) of (``doc``, ``text``): the reference has a window of the document and comes first."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = max(1, -(-3 * size // SHARD_BYTES))  # a window is a word: some 6 bytes of text, 20 of hash and id
    n_parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-n_shards // PART_SHARDS), MAX_PARTS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(texts: list[list[bytes]], ids: list[int]) -> pa.RecordBatch:
            (high, low), owners, pairs = settle(*window_hashes(texts, np.array(ids, np.int64), n))
            shard = ((high >> np.uint64(16)) % np.uint64(n_shards)).astype(np.int64)
            order = np.lexsort((owners, shard))
            high, low, owners, shard = high[order], low[order], owners[order], shard[order]
            starts = np.flatnonzero(np.diff(shard, prepend=-1))
            rows = [(int(shard[a]), high[a:b].tobytes(), low[a:b].tobytes(), packed(owners[a:b])) for a, b in zip(starts, [*starts[1:], len(shard)], strict=True)] if len(shard) else []
            if len(pairs):  # settled here; any shard passes them on
                rows.append((int(pairs[0, 0]) % n_shards, b"", b"", pairs.astype(np.int64).tobytes()))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["shard", "hashes", "more", "docs"])

        only("substrings")
        texts: list[list[bytes]] = []
        ids: list[int] = []
        size = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text"), strict=True):
                words = words_of(text.as_py())
                if len(words) < n:
                    continue
                texts.append(words)
                ids.append(doc.as_py())
                size += len(words)
                if size >= BATCH_WORDS:
                    yield sent(texts, ids)
                    texts, ids, size = [], [], 0
        if texts:
            yield sent(texts, ids)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["doc", "ref"])

        def found(rows: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
            high, low = (np.frombuffer(b"".join(r[i] for r in rows), t) for i, t in enumerate((np.uint64, np.uint32)))
            return out(settle((high, low), np.concatenate([unpacked(r[2]) for r in rows]))[2])

        shard, rows = None, []
        for batch in batches:
            for s, *row in zip(batch.column("shard").to_pylist(), *(batch.column(c) for c in ("hashes", "more", "docs")), strict=True):
                hashes, more, docs = (x.as_py() for x in row)
                if not hashes:
                    yield out(np.frombuffer(docs, np.int64).reshape(-1, 2))
                    continue
                if s != shard and rows:
                    yield found(rows)
                    rows = []
                shard = s
                rows.append((hashes, more, docs))
        if rows:
            yield found(rows)

    dealt = docs.mapInArrow(deal, "shard long, hashes binary, more binary, docs binary")
    dealt = dealt.repartition(n_parts, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(collect, "doc long, ref long").distinct()


def _streamed(pairs: DataFrame, n: int) -> DataFrame:
    """(``doc``, ``k2``, ``start``, ``stop`` arrays) of pairs with both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[tuple, tuple[Automaton, int]] = OrderedDict()
        held = 0
        for batch in batches:
            starts, stops = [], []
            for ref, h, ref_text, text in zip(*(batch.column(c) for c in ("ref", "ref_k2", "ref_text", "text")), strict=True):
                key = ref.as_py(), h.as_py()
                if key not in kept:
                    words = words_of(ref_text.as_py())
                    kept[key] = Automaton(words), len(words)
                    held += len(words)
                    while held > AUTOMATA_WORDS and len(kept) > 1:
                        held -= kept.popitem(last=False)[1][1]
                kept.move_to_end(key)
                spans = kept[key][0].spans(words_of(text.as_py()), n)
                starts.append([a for a, _ in spans])
                stops.append([b for _, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("k2"), pa.array(starts, pa.list_(pa.int32())), pa.array(stops, pa.list_(pa.int32()))], names=["doc", "k2", "start", "stop"])

    return pairs.mapInArrow(run, "doc long, k2 long, start array<int>, stop array<int>")


def remove_repeats(df: DataFrame, doc_id: str, text: str, *, n: int = WINDOW, carry: list[str] | None = None, keep_text: bool = True) -> DataFrame:
    """Columns ``carry`` (default all but the text) with ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text``."""
    made = {"n_words": "long", "n_removed": "long", "kept_sha256": "string"} | ({"kept_text": "string"} if keep_text else {})
    keep = [c for c in (df.columns if carry is None else carry) if c not in made and c != text]
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    if not isinstance(df.schema[doc_id].dataType, T.IntegralType):  # other ids are compared as they are, by their places in order
        places = numbered(df.select(F.col(doc_id).alias("__of_id")).where("__of_id is not null").distinct(), "__place", "__of_id")
        df, order = df.join(places, F.col(doc_id) == F.col("__of_id"), "left"), F.coalesce("__place", F.lit(LAST))
    docs = df.select(order.alias("doc"), F.col(text).alias("text"))
    pairs = materialize(_pairs(docs, n), "pairs")

    # Texts that a pair needs; other documents' results are done here.  Sort-merge joins at every
    # size: what they exchange grows with the corpus, so it is planned as growing from the start.
    as_doc, as_ref = pairs.select("doc").distinct().withColumn("__hit", F.lit(True)), pairs.select(F.col("ref").alias("doc")).distinct().withColumn("__ref", F.lit(True))
    wanted = as_doc.join(as_ref.hint("merge"), "doc", "full").withColumnRenamed("doc", "__doc")
    shield = [f"__c{i}" for i in range(len(keep))]  # the caller's columns may be named like ours
    rows = df.select(*(F.col(f"`{c}`").alias(x) for c, x in zip(keep, shield, strict=True)), order.alias("doc"), F.xxhash64(F.col(text)).alias("k2"), F.col(text).alias("__text"))
    rows = rows.join(wanted.hint("merge"), F.col("doc") == F.col("__doc"), "left").drop("__doc")
    kept = ", ".join(f"`{x}` {f.dataType.simpleString()}" for f, x in zip(df.select(*(F.col(f"`{c}`") for c in keep)).schema.fields, shield, strict=True))
    results = ", ".join(f"{k} {v}" for k, v in made.items())

    def finished(batch: pa.RecordBatch, texts, starts, stops) -> list[pa.Array]:
        """The result columns of rows with these spans."""
        columns: dict[str, list] = {k: [] for k in made}
        for t, first, last in zip(texts, starts, stops, strict=True):
            words = words_of(t.as_py())
            keep_word = np.ones(len(words), bool)
            for a, b in zip(first or (), last or (), strict=True):
                keep_word[a:b] = False
            left = words if keep_word.all() else [words[i] for i in np.flatnonzero(keep_word)]
            rest = b" ".join(left)
            columns["n_words"].append(len(words))
            columns["n_removed"].append(len(words) - len(left))
            columns["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
            if keep_text:
                columns["kept_text"].append(rest.decode())
        return [pa.array(columns[k], pa.int64() if v == "long" else pa.string()) for k, v in made.items()]

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results as if nothing repeated; the text stays where a pair needs it."""
        for batch in batches:
            needed = [h.as_py() or r.as_py() for h, r in zip(batch.column("__hit"), batch.column("__ref"), strict=True)]
            none = [None] * batch.num_rows
            texts = pa.array([t.as_py() if x else None for t, x in zip(batch.column("__text"), needed, strict=True)], pa.string())
            names = [*shield, "doc", "k2", "__hit", "__ref"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), texts, *finished(batch, batch.column("__text"), none, none)], names=[*names, "__text", *made])

    rows = materialize(rows.mapInArrow(plain, ", ".join(x for x in (kept, "doc long, k2 long, __hit boolean, __ref boolean, __text string", results) if x)), "marked")
    texts = rows.where("__hit").select("doc", "k2", F.col("__text").alias("text"))
    refs = rows.where("__ref").select(F.col("doc").alias("ref"), F.col("k2").alias("ref_k2"), F.col("__text").alias("ref_text")).dropDuplicates(["ref", "ref_k2"])
    spans = _streamed(pairs.join(texts.dropDuplicates(["doc", "k2"]).hint("merge"), "doc").join(refs.hint("merge"), "ref"), n)
    spans = spans.where(F.size("start") > 0).groupBy("doc", "k2").agg(F.flatten(F.collect_list("start")).alias("__start"), F.flatten(F.collect_list("stop")).alias("__stop"))
    spans = materialize(spans.withColumnsRenamed({"doc": "__d", "k2": "__k"}), "spans")
    discard(pairs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = finished(batch, batch.column("__text"), batch.column("__start").to_pylist(), batch.column("__stop").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in shield), *new], names=[*shield, *made])

    same = rows.where("__hit is null").select(*shield, *made)
    hit = rows.where("__hit").join(spans.hint("merge"), (F.col("doc") == F.col("__d")) & (F.col("k2") == F.col("__k"))).select(*shield, "__text", "__start", "__stop")
    unhit = rows.where("__hit").join(spans.hint("merge"), (F.col("doc") == F.col("__d")) & (F.col("k2") == F.col("__k")), "left_anti").select(*shield, *made)
    out = same.unionAll(unhit).unionAll(hit.mapInArrow(cut, ", ".join(x for x in (kept, results) if x)))
    return out.toDF(*keep, *made)


def op3_substrings(spark, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that an earlier one has; a null text has no words."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return remove_repeats(docs, "doc_id", "text", carry=["doc_id"], keep_text=False)


OP3_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i0, array_to_string(list_slice(w, i0, i0 + {WINDOW - 1}), ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS i0)),
f AS (SELECT s, min(doc_id) AS first FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)),
x AS (SELECT DISTINCT doc_id, unnest(range(i0, i0 + {WINDOW})) AS pos FROM s JOIN f ON s.s = f.s WHERE doc_id > first),
p AS (SELECT doc_id, pos, w[pos] AS word FROM d, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS pos)),
k AS (SELECT p.doc_id, count(*) AS n_kept, sha256(string_agg(word, ' ' ORDER BY p.pos)) AS kept_sha256 FROM p ANTI JOIN x ON p.doc_id = x.doc_id AND p.pos = x.pos GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
