"""Phrases against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockmill.llm import collocations as c
from dockmill.llm import shards

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f.update((lang or "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    sub = lambda p: {(p[0], p[1][i:j]) for i in range(len(p[1])) for j in range(i + 1, len(p[1]) + 1)} - {p}
    gone = {q for p, b in found.items() for q in sub(p) if q in found and 100 * b >= 80 * found[q]}
    out = {}
    for (lang, w), a in found.items():
        if (lang, w) not in gone:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, left, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, r) in enumerate(sorted(rows)[:top], 1))


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["New", "york", "the", "city", "of", "a", "a", "Ünder", "x\x85y", "été", "--"]
    return [(rng.choice(["en", "fr", None]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " New york city "]) for _ in range(rng.randrange(0, 60)))) for _ in range(n)]


def test_equals_brute_force(spark):
    docs = [*corpus(1, 150), ("en", None), ("en", ""), ("zz", "alone"), (None, "...")]
    df = spark.createDataFrame(docs, "lang string, text string").withColumns({"word": F.lit("clash"), "shard": F.lit(1)}).repartition(4)
    got = sorted(tuple(r) for r in c.collocations(df, "lang", "text", least=5, top=40).collect())
    assert got == brute(docs, 5, 40) and len(got) > 60


@pytest.mark.parametrize("size,segment,rows", [(40, 30, 10), (1000, 100, 300_000), (7, 1, 1)])
def test_shards_and_bitmaps_count_each_phrase_once(monkeypatch, size, segment, rows):
    monkeypatch.setattr(shards, "SHARD", size)
    monkeypatch.setattr(shards, "SEGMENT", segment)
    monkeypatch.setattr(c, "ROWS", rows)
    docs = [(x or "und", t) for x, t in corpus(2, 30)] + [("en", "a a a a a. " * 30), ("en", "word " * 40), ("en", "n" * 300)]
    cutter, batches = c.Cutter(0), []
    for lang, text in docs:
        batches += cutter.add(lang, text.encode())
    batches += cutter.close()
    names, seen, counts = {}, Counter(), Counter()
    for b in batches:
        for r in b.to_pylist():
            if r["word"] is not None:
                names[r["local"]] = (r["lang"], r["word"].decode())
                counts[r["lang"], r["word"].decode()] += r["n"]
            else:
                s = c.Shard(np.frombuffer(r["places"], np.int32), r["n_start"])
                a, b2, n = s.pairs()
                for x, y, k in zip(a.tolist(), b2.tolist(), n.tolist()):
                    seen[names[x][0], names[x][1], names[y][1]] += k
                for ws, n in s.longer(a * s.base + b2):
                    for *w, k in zip(*(v.tolist() for v in ws), n.tolist()):
                        seen[(names[w[0]][0], *(names[i][1] for i in w if i))] += k
                names = {}
    want, words = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words.update((lang, x) for x in w)
            for k in range(2, 5):
                want.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    assert +seen == want and +counts == words


def test_scores_are_exact_beyond_64_bits(spark):
    big = spark.sql("select 9000000000000000000 as a, 9000000000000000001 as l, 9000000000000000003 as r")
    exact = "cast(2000000 as decimal(19, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))"
    assert big.selectExpr(f"{exact} as s").first()[0] == 2000000 * 9000000000000000000 // 18000000000000000004


def test_long_texts_and_empty_tables(spark):
    rows = [("en", "new york " * 100_000), ("en", "x" * 2_000_000), ("en", "of the city. " * 40)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in c.collocations(docs, "lang", "text").collect())
    assert got == brute(rows, 30, 2000) and len(got) == 3
    assert c.collocations(docs.limit(0), "lang", "text").count() == 0
    assert c.collocations(docs.limit(1), "lang", "text", least=10**7).count() == 0
