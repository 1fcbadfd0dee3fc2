"""Substring dedup, decontamination, the pipeline."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from dockmill.llm.decontamination import decontaminate, indexed, proximity
from dockmill.llm.substrings import Automaton, packed, remove_repeats, settle, unpacked, window_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_automaton_matches_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        ref = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(30))]
        doc = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(30))]
        n = rng.randrange(1, 5)
        grams = {tuple(ref[i : i + n]) for i in range(len(ref) - n + 1)}
        want = {i + j for i in range(len(doc) - n + 1) if tuple(doc[i : i + n]) in grams for j in range(n)}
        assert {i for a, b in Automaton(ref).spans(doc, n) for i in range(a, b)} == want


def test_windows_that_share_64_bits_are_told_apart():
    """Documents 1 and 2 have different windows with the same first 64 bits; 3 and 4 repeat one each."""
    high, low = np.array([5, 5, 5, 5, 9], np.uint64), np.array([1, 2, 2, 1, 1], np.uint32)
    (h, g), docs, pairs = settle((high, low), np.array([1, 2, 3, 4, 2]))
    assert pairs.tolist() == [[3, 2], [4, 1]] and sorted(zip(h.tolist(), g.tolist(), docs.tolist())) == [(5, 1, 1), (5, 2, 2), (9, 1, 2)]
    texts = [[b"%d" % (i * j) for j in range(30)] for i in range(1, 9)]
    (h, g), owners = window_hashes(texts, np.arange(8), 13)
    words = [tuple(t[k : k + 13]) for t in texts for k in range(18)]
    assert len(h) == len(g) == len(owners) == len(words) and len(set(g.tolist())) == len(set(h.tolist())) == len(set(words))


def test_ids_are_packed_whole():
    rng = random.Random(1)
    for most in (1, 200, 60_000, 2**31, 2**62):
        for n in (1, 2, 500):
            ids = np.sort(np.array([rng.randrange(-most, most) for _ in range(n)], np.int64))
            assert (unpacked(packed(ids)) == ids).all() and len(packed(ids)) <= 9 + 8 * n
    assert unpacked(packed(np.array([-(2**63), 2**63 - 1]))).tolist() == [-(2**63), 2**63 - 1]


def brute_repeats(rows, n):
    texts = [(2**63 - 1 if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    out = []
    for i, w in texts:
        earlier = {tuple(v[k : k + n]) for j, v in texts if j < i for k in range(len(v) - n + 1)}
        gone = {k + m for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in earlier for m in range(n)}
        rest = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((None if i == 2**63 - 1 else i, len(w), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return sorted(out, key=str)


def test_repeats_match_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [[word() for _ in range(20)] for _ in range(3)]
    rows = []
    for i in range(60):
        t = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            t += rng.choice(passage)[: rng.randrange(8, 21)] + [word() for _ in range(5)]
        rows.append((i, " ".join(t)))
    rows += [(70, rows[3][1]), (71, rows[3][1]), (71, rows[3][1]), (None, rows[3][1]), (None, rows[4][1] + " é"), (80, None), (81, ""), (82, "\x0b one\x0ctwo ")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc", F.lit("clash"))
    got = remove_repeats(df, "doc_id", "text", n=6, carry=["doc_id", "doc"])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == brute_repeats(rows, 6)
    assert remove_repeats(df.limit(0), "doc_id", "text").count() == 0


def brute_hits(docs, items, n):
    low = lambda t: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    cut = [("" if i is None else str(i), w[k : k + n]) for i, t in items if (w := low(t)) for k in range(max(1, len(w) - n + 1))]
    out = []
    for i, t in docs:
        w, hit, found = low(t), set(), set()
        for item, p in cut:
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    found.add(item)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_hits_match_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["Ab", "c", "d", "é", "x1"]) + rng.choice(["", ",", "-", "İ"]) for _ in range(n))
    items = [(i, text(rng.randrange(9))) for i in range(12)] + [(3, text(6)), (None, text(7)), (50, None), (51, "..."), (52, "lone")]
    docs = [(i, text(rng.randrange(30))) for i in range(40)] + [(40, items[5][1]), (40, items[5][1]), (None, text(25)), (42, None), (43, ""), (44, "Lone LONE")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").withColumn("k1", F.lit("clash")), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(d, "doc_id", "text", b, "item_id", "text", n=4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == brute_hits(docs, items, 4)
    none = decontaminate(d, "doc_id", "text", b.limit(0), "item_id", "text").where("contaminated").count()
    assert none == 0 and decontaminate(d.limit(0), "doc_id", "text", b, "item_id", "text").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one x two y three"), (2, "three two one"), (3, "one two q q q three")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    index, _ = indexed(docs, "doc_id", "text", items, "item_id", "text", n=10)
    find = lambda slack: {r.k1 for r in proximity(index, slack).collect()}
    assert find(0) == {2} and find(2) == {1, 2} and find(3) == {1, 2, 3}


def test_proximity_matches_brute_force(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(25)))) for i in range(40)] + [(None, "a b c d"), (50, None)]
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 5)))) for i in range(6)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index, having = indexed(d, "doc_id", "text", b, "item_id", "text", n=3)
    phrases = {tuple(w[k : k + 3]) for _, t in items for w in [t.split()] for k in range(max(1, len(w) - 2))}
    want = set()
    for i, t in docs:
        w = (t or "").split()
        for p in phrases:
            reach = min(len(p) + 2, len(w))
            if any(set(p) <= set(w[k : k + reach]) for k in range(len(w) - reach + 1)) and w:
                want.add((i, p))
    name = {r.nr: tuple(r.phrase) for r in index.windows.collect()}
    assert {(r.k1, name[r.nr]) for r in proximity(index, 2).collect()} == want and want
    assert {r.nr for r in having.collect()} >= set(name)


def test_pipeline_matches_its_parts(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(8)
    word = lambda: rng.choice(["the", "of", "and", "to", "house", "river", "garden", "stone", "window", "light"]) + rng.choice(["", "s", "ed"])
    prose = lambda n: ". ".join(" ".join(word() for _ in range(8)) for _ in range(n // 8)) + "."
    texts = [prose(160) for _ in range(12)]
    texts[3] = texts[2] + " end"
    bench = " ".join(f"q{i}" for i in range(12))
    texts[5] = texts[5] + " " + bench
    texts[7] = texts[7] + " mail ann@site.org"
    texts += ["short", None, "### $$$ " * 60]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in p.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(12)) - {3, 5}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert "<EMAIL>" in p.pii(spark, docs, str(tmp_path)).where("doc_id = 7").first().text
    assert got[0].decoded_sha256 == hashlib.sha256(texts[0].encode()).hexdigest() and got[7].decoded_sha256 != hashlib.sha256(texts[7].encode()).hexdigest()
