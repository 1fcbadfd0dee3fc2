"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockmill.llm import importance
from dockmill.llm.importance import BUCKETS, hashed, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, items):
    bucket = lambda f: zlib.crc32(f.encode()) % BUCKETS
    S, T = np.zeros(BUCKETS, int), np.zeros(BUCKETS, int)
    for counts, texts in ((S, [t for _, t in docs]), (T, items)):
        for t in texts:
            for f in features(t)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t + 1.0) * (float(S.sum()) + BUCKETS) / ((s + 1.0) * (float(T.sum()) + BUCKETS)))) for s, t in zip(S.tolist(), T.tolist())]
    rows = []
    for d, t in docs:
        n, fs = features(t)
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
        rows.append([d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: i for i, r in enumerate(able[: 5 * len(able) // 100], 1)}
    return {r[0]: (*r[2:], rank.get(r[0])) for r in rows}


def texts(seed, n):
    rng = random.Random(seed)
    words = ["The", "river", "GARDEN", "straße", "Ünder", "日本語", "x1", "a", "don't", "é" * 30, "w" * 300, "re-run", "\x00", "😀"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) + rng.choice(["", ".", "\n\n"]) for _ in range(n)]


def test_equals_brute_force(spark):
    docs = [*enumerate(texts(1, 300)), (300, None), (301, ""), (302, "one"), (303, "...")]
    items = [*texts(2, 5), None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"weight": F.lit("clash"), "__text": F.lit(1)}).repartition(3)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in resample(df, "doc_id", "text", target, "text").collect()}
    want = brute(docs, items)
    assert got == want and sum(r[3] is not None for r in got.values()) > 5


@pytest.mark.parametrize("window", [1, 7, 64, 1000])
def test_windows_of_bytes_change_nothing(monkeypatch, window):
    monkeypatch.setattr(importance, "WINDOW", window)
    rows = texts(3, 20) + ["ab", "cd ef", "", "gh", "x" * 9000, "y z " * 3000]
    arr = pa.array([None, *rows, None]).slice(1, len(rows))
    seen: dict[int, list] = {i: [] for i in range(len(rows))}
    n_words = np.zeros(len(rows), int)
    for of_word, owner, crc in hashed(arr):
        n_words += np.bincount(of_word, minlength=len(rows))
        for d, c in zip(owner.tolist(), crc.tolist()):
            seen[d].append(c)
    for i, t in enumerate(rows):
        n, fs = features(t)
        assert n_words[i] == n and sorted(seen[i]) == sorted(zlib.crc32(f.encode()) for f in fs), i


def test_long_texts_repeated_rows_and_empty_tables(spark):
    long = [(1, "x" * 2_000_000), (2, "y z " * 200_000), (3, "the garden " * 30), (3, "the garden " * 30), (None, "the garden " * 30)]
    df = spark.createDataFrame(long, "doc_id long, text string")
    target = spark.createDataFrame([("the garden",)], "text string")
    got = resample(df, "doc_id", "text", target, "text", percent=50).collect()
    assert [r.n_features for r in got if r.doc_id == 2] == [3 * 400_000 - 3] and len(got) == 5
    assert sorted(r.rank for r in got if r.rank) == [1, 2] and len({r.score for r in got if r.doc_id == 3}) == 1
    assert resample(df.limit(0), "doc_id", "text", target, "text").count() == 0
    assert resample(df, "doc_id", "text", target.limit(0), "text").count() == 5
