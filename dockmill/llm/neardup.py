"""Near-duplicates: fast similarity sketches, banding, exact verification.

A document's set is that of its word shingles.  Its sketch follows Dahlgaard,
Knudsen and Thorup (2017): in each round every element throws a hash into a
random bin, earlier rounds win, and after as many rounds as there are bins the
remaining bins take the least hash of all elements each, so every coordinate is
filled, two sets agree in a coordinate with probability their Jaccard
similarity, and the number of agreements is concentrated.  It costs about
t log t + |set| steps rather than t |set|.

Documents with equal sets form a class; classes are the nodes of the graph.
Sketches are cut into bands, and classes that agree in a band share a bucket.
With 64 bands of 7 coordinates a pair at the threshold 0.8 shares no bucket with
probability 3e-7.  Within a bucket:

1. every member is compared with the bucket's smallest member, on full sets;
2. after joining what is linked, buckets whose members lie in several components
   are searched for the rest: sketches of members of different components are
   compared block by block, and pairs that may be similar (estimate within five
   standard deviations of the threshold) are compared on full sets until their
   components are joined.

Pairs inside one component need no comparison, so a large group of copies costs
a comparison per member and band; no pair is dropped for being in a large bucket.

Defined results: a document without words has an empty set, is linked with
nothing and is its own component; with fewer words than a shingle the whole
sequence is one shingle; a null id never becomes a component's id unless all its
documents have none; every row gives one row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.llm.memo import only, register
from dockmill.plans.components import components
from dockmill.plans.shared import discard, materialize, small, spread

BANDS, ROWS = 64, 7
BLOCK = 1024
MAX_BUCKETS = 1_000_000
MEMO_WORDS = 600_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_NONE = np.uint64(2**64 - 1)
_LOW = np.uint64(2**40 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(n: int, salt: int) -> np.ndarray:
    return _mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15))


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()
register("neardup", _hashes.clear)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size = min(k, len(h))
    factors = _stream(size, 1) | np.uint64(1)
    total = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        total += h[j : len(h) - size + 1 + j] * factors[j]
    return np.unique(_mix(total))


class Sketcher:
    """Fast similarity sketches of ``t`` coordinates."""

    def __init__(self, t: int):
        self.t, self.seeds = t, _stream(2 * t, 2)

    def sketch(self, items: np.ndarray) -> np.ndarray:
        t, n = self.t, len(items)
        out, at = np.full(t, _NONE), 0
        while at < t:
            k = int(min(t - at, max(1, 2 * t // n)))
            self._throw(out, items, at, k)
            at += k
            if (out != _NONE).all():
                return out
        for j in np.flatnonzero(out == _NONE):
            x = _mix(items ^ self.seeds[t + j])
            out[j] = (np.uint64(t + int(j)) << np.uint64(40)) | (x & _LOW).min()
        return out

    def _throw(self, out: np.ndarray, items: np.ndarray, at: int, k: int) -> None:
        """Rounds ``at`` to ``at + k``: how many run at once doesn't change the result, since earlier rounds win."""
        x = _mix(items[None, :] ^ self.seeds[at : at + k, None])
        bins = ((x >> np.uint64(40)) * np.uint64(self.t)) >> np.uint64(24)
        values = (np.arange(at, at + k, dtype=np.uint64)[:, None] << np.uint64(40)) | (x & _LOW)
        np.minimum.at(out, bins.ravel().astype(np.int64), values.ravel())


def _sketched(df: DataFrame, carry: list[str], text: str, k: int, bands: int, rows: int) -> DataFrame:
    """Columns ``carry`` with ``n_shingles``, ``digest`` of the set, ``bands`` and a byte per coordinate (``sketch``)."""
    rest = [f for f in df.schema.fields if f.name in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("neardup")
        sketcher, factors, salts = Sketcher(bands * rows), _stream(rows, 3) | np.uint64(1), _stream(bands, 4)
        for batch in batches:
            sizes, digests, keys, bytes_ = [], [], [], []
            for t in batch.column("__nd_text"):
                items = shingles(t.as_py(), k)
                sizes.append(len(items))
                if not len(items):
                    digests.append(None), keys.append(None), bytes_.append(None)
                    continue
                digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                mixed = _mix(sketcher.sketch(items))
                keys.append(_mix((mixed.reshape(bands, rows) * factors).sum(axis=1, dtype=np.uint64) ^ salts).view(np.int64))
                bytes_.append(mixed.astype(np.uint8).tobytes())
            made = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bytes_, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in rest] + made, names=[*(f.name for f in rest), "n_shingles", "digest", "bands", "sketch"])

    made = df.select(*(F.col(f.name) for f in rest), F.col(text).alias("__nd_text"))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "n_shingles long, digest binary, bands array<long>, sketch binary"])
    return made.mapInArrow(run, fields)


def _sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(``node``, ``items``): the full sets of ``nodes``, from the text of a document each."""
    keys = classes.join(nodes, "node", "left_semi").select("node", "k1", "k2")
    texts = docs.join(keys, F.col("__d1").eqNullSafe(F.col("k1")) & (F.col("__d2") == F.col("k2"))).select("node", F.col("__nd_text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t.as_py(), k).view(np.int64) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "items"])

    return texts.mapInArrow(run, "node long, items array<long>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``: nodes) that are similar enough, on full sets."""
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    sets = materialize(_sets(wanted, classes, docs, k), "sets")
    left, right = sets.select(F.col("node").alias("a"), F.col("items").alias("x")), sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    similar = 100 * common >= percent * (F.size("x") + F.size("y") - common)
    out = materialize(both.where(similar).select("a", "b"), "links")
    discard(sets)
    return out


def _residual(members: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int, t: int) -> DataFrame:
    """Links (``a``, ``b``) between nodes of one bucket but different components that join what can be joined.

    ``members``: (``bucket``, ``node``, ``root``).  A bucket of many members is cut
    into blocks, and a task compares two blocks at a time: sketches first, full
    sets where those may be similar enough.  A pair is compared in the first
    bucket that it shares only, and not at all once links found in the task have
    joined its components, so a task returns fewer links than it has members.
    """
    counts = materialize(members.groupBy("bucket").agg(F.count("*").alias("n")), "counts")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = members.join(small(counts, MAX_BUCKETS), "bucket").withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = placed.select("bucket", "node", "root", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("bucket", "node", "root", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    sets = materialize(_sets(members.select("node").distinct(), classes, docs, k), "sets")
    dealt = dealt.join(classes.select("node", "bands", "sketch"), "node").join(sets, "node")
    share = percent / 100
    least = t * (share - 5 * (share * (1 - share) / t) ** 0.5)

    def compare(df: pd.DataFrame) -> pd.DataFrame:
        bucket, lo, hi = df["bucket"].iat[0], df["lo"].iat[0], df["hi"].iat[0]
        xs, ys = df[df["mine"] == lo], df[df["mine"] == hi]
        sketches = lambda d: np.frombuffer(b"".join(d["sketch"]), np.uint8).reshape(len(d), t)
        x, y, x_bands, y_bands = sketches(xs), sketches(ys), np.stack(xs["bands"].to_list()), np.stack(ys["bands"].to_list())
        xr, yr, xn, yn = xs["root"].to_numpy(), ys["root"].to_numpy(), xs["node"].to_numpy(), ys["node"].to_numpy()
        x_items, y_items = xs["items"].to_list(), ys["items"].to_list()
        above: dict[int, int] = {}

        def top(r: int) -> int:
            while r in above:
                r = above[r]
            return r

        found = []
        for i in range(len(x)):
            for j in np.flatnonzero(((y == x[i]).sum(axis=1) >= least) & (yr != xr[i]) & ((yn > xn[i]) | (lo != hi))):
                r, s = top(int(xr[i])), top(int(yr[j]))
                if r == s or x_bands[i][int((x_bands[i] == y_bands[j]).argmax())] != bucket:
                    continue
                common = len(np.intersect1d(x_items[i], y_items[j], assume_unique=True))
                if 100 * common >= percent * (len(x_items[i]) + len(y_items[j]) - common):
                    above[max(r, s)] = min(r, s)
                    found.append((xn[i], yn[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    links = materialize(dealt.groupBy("bucket", "lo", "hi").applyInPandas(compare, "a long, b long"), "links")
    discard(sets)
    return links


def near_duplicates(df: DataFrame, doc_id: str, text: str, *, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (default all) with ``n_shingles``, ``component_id`` and ``first_of_component``.

    ``component_id`` is the smallest id of the component; ``first_of_component``
    holds for one row of each component, one that has that id.
    """
    made = ("n_shingles", "component_id", "first_of_component")
    keep = [c for c in (df.columns if carry is None else carry) if c not in made]
    docs = df.select(F.col(doc_id).alias("__d1"), F.xxhash64(F.col(text)).alias("__d2"), F.col(text).alias("__nd_text"))
    shield = [f"__c{i}" for i in range(len(keep))]  # the caller's columns may be named like ours
    start = df.select(*(F.col(f"`{c}`").alias(x) for c, x in zip(keep, shield, strict=True)), F.col(doc_id).alias("__d1"), F.xxhash64(F.col(text)).alias("__d2"), F.col(text).alias("__t"))
    rows_ = materialize(_sketched(start, [*shield, "__d1", "__d2"], "__t", k, bands, rows).withColumn("__row", F.monotonically_increasing_id()), "sketched")

    # Classes of equal sets; all their rows have the same bands and sketch.
    first = F.struct(F.col("__d1").isNull().alias("no_id"), F.col("__d1").alias("id"), F.col("__row").alias("row"))
    classes = rows_.where("digest is not null").groupBy("digest").agg(F.min("__row").alias("node"), F.min(first).alias("first"), F.min_by(F.struct("__d1", "__d2", "bands", "sketch"), "__row").alias("c"))
    classes = materialize(classes.select("digest", "node", "first", F.col("c.__d1").alias("k1"), F.col("c.__d2").alias("k2"), "c.bands", "c.sketch"), "classes")

    # Buckets with at least two classes.
    in_bands = classes.select("node", F.explode_outer("bands").alias("bucket"))
    buckets = in_bands.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other").select("bucket", "hub")
    members = materialize(in_bands.join(buckets, "bucket"), "members")
    pairs = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = _verified(pairs, classes, docs, k, percent)
    roots = components(links)

    # Buckets that still hold several components besides the hub's comparisons.
    placed = members.where("node <> hub").join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    placed = materialize(placed, "placed")
    open_ = materialize(placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket"), "open")
    rest = materialize(placed.join(small(open_, MAX_BUCKETS), "bucket", "left_semi"), "rest")
    if rest.limit(1).count():
        roots = components(links.unionAll(_residual(rest, classes, docs, k, percent, bands * rows)))
    discard(rest, placed, members)
    rooted = classes.select("digest", "node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    known = rooted.join(least, "root").select("digest", F.col("least.id").alias("__id"), F.col("least.row").alias("__first"))
    joined = rows_.drop("bands", "sketch").join(known.withColumnRenamed("digest", "__digest"), F.col("digest") == F.col("__digest"), "left")
    alone = F.col("digest").isNull()
    back = [F.col(x).alias(c) for c, x in zip(keep, shield, strict=True)]
    return joined.select(*back, "n_shingles", F.when(alone, F.col("__d1")).otherwise(F.col("__id")).alias("component_id"), (alone | (F.col("__row") == F.col("__first"))).alias("first_of_component"))


def op2_neardup(spark, sf_dir: str) -> DataFrame:
    """Class and component of every document under 4-word shingles at 80 percent; a document without words is alone."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = near_duplicates(docs, "doc_id", "text", k=4, carry=["doc_id"])
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


_A, _a = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP2_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', '{_a}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i0, i0 + 3) AS s FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i0) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT r.doc_id, b FROM r JOIN both_ways ON r.root = a),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
