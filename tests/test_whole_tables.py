"""Queries over whole tables that have no SQL, against plain Python on the smallest tables."""

import hashlib
import math
import re
from itertools import groupby

import pyarrow.parquet as pq

from dockmill.functions.text import CUT_ENDINGS
from dockmill.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def rows(table, *columns):
    return sorted(tuple(r.values()) for r in pq.read_table(f"{DATA}/{table}.parquet", columns=list(columns)).to_pylist())


def test_word_jaccard(spark):
    sets = {i: {w for w in re.split(r"[^a-z0-9_]+", text.lower()) if len(w) > 2} for i, text in rows("documents", "doc_id", "text")}
    want = {i: len(sets[i] & sets[i + 1]) / max(len(sets[i] | sets[i + 1]), 1) for i in sets if i + 1 in sets}
    got = {r.a: (r.b, r.similarity) for r in QUERIES["word_jaccard"](spark, DATA).collect()}
    assert len(want) > 59 and got.keys() == want.keys()
    assert all(b == a + 1 and math.isclose(x or 0, want[a], abs_tol=1e-6) for a, (b, x) in got.items())


def test_ordered_texts(spark):
    docs = sorted((lang, i // 50, i, text) for i, lang, text in rows("documents", "doc_id", "lang", "text"))
    want = {k: "\n".join(d[3] for d in of) for k, of in groupby(docs, lambda d: d[:2])}
    got = {(r.region, r.block): r.text for r in QUERIES["ordered_texts"](spark, DATA).collect()}
    assert max(d[2] for d in docs) >= 199 and got == want


def first(text):
    parts = re.split(r"\.\s+", text, flags=re.ASCII)
    if len(parts) < 2:
        return None
    return f"{parts[0]}. {parts[1]}" if parts[0].endswith(tuple(f" {e}" for e in CUT_ENDINGS)) else parts[0]


def test_first_sentences(spark, tmp_path):
    own = [(1, "we met Dr. Who today. More"), (2, "Costs, 3 in all. More"), (3, "one part"), (4, "Harm to U.S. Citizens. More"), (5, None)]
    spark.createDataFrame(own, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'x' AS source").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.ord: r.sentence for r in QUERIES["first_sentences"](spark, str(tmp_path)).collect()}
    assert got == {1: "we met Dr. Who today", 2: "Costs, 3 in all", 3: None, 4: "Harm to U.S. Citizens", 5: None}
    got = {r.ord: r.sentence for r in QUERIES["first_sentences"](spark, DATA).collect()}
    assert got == {i: first(text) for i, text in rows("documents", "doc_id", "text")}


def test_prompt_cache_join(spark):
    events = rows("events", "event_id")
    got = {r.event_id: (r.result, r.hit) for r in QUERIES["prompt_cache_join"](spark, DATA).collect()}
    digest = lambda i: hashlib.sha256(str(i).encode()).hexdigest()[:12]
    assert got == {i: (f"kept {i}", True) if i % 4 == 0 else (f'{{"relevance": 1, "digest": "{digest(i)}"}}', False) for (i,) in events}
