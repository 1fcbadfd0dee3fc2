"""The stored search index against a scan of all texts."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockmill.operators import search_index
from dockmill.operators.explore import matches, parse_search
from dockmill.operators.search_index import Need, TextIndex, _grams, index_of

WORDS = ["the", "them", "of the", "çà", "日本", "a", "b", "zzz", "org src1", "x", "no", "\0", "😀"]
QUERIES = ["the", "th", "t", "-t", "them -the", "ça OR çà", "日 OR 😀", '"of the" -b', "-zzz -x", "a OR -them", "missing", "-missing", "th -a", "x -x", '"the the"', "The OR A no", "-\0 x", "b\0", '"']


def texts(n, seed=5):
    rng = random.Random(seed)
    return [rng.choice(["", " ", "-"]).join(rng.choice(WORDS) for _ in range(rng.randrange(0, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def index(spark):
    rows = [(i, t, "kept") for i, t in enumerate(texts(400))] + [(400, None, "kept"), (401, "", "kept"), (401, "", "kept")]
    df = spark.createDataFrame(rows, "id long, text string, block string").repartition(3).cache()
    return df, TextIndex.build(df, F.lower("text"), part_bits=6)


@pytest.mark.parametrize("query", QUERIES)
def test_finds_what_a_scan_finds(index, query):
    df, built = index
    tokens = parse_search(query)
    want = sorted(r.id for r in df.where(matches(F.lower(F.coalesce("text", F.lit(""))), tokens)).collect())
    found = built.search(tokens)
    assert found.columns == df.columns and sorted(r.id for r in found.collect()) == want


def test_masks_are_bounds(index):
    df, built = index
    for query in QUERIES:
        if tokens := parse_search(query):
            bits = built.masks(tokens).collect()
            sure, maybe = sum(int(r.sure & (2**64 - 1)).bit_count() for r in bits), sum(int(r.maybe & (2**64 - 1)).bit_count() for r in bits)
            n = df.where(matches(F.lower(F.coalesce("text", F.lit(""))), tokens)).count()
            assert sure <= n <= sure + maybe
            assert all(Need.of(t.value).exact for t in tokens) <= (maybe == 0)


def test_only_parts_with_candidates_are_read(spark):
    rows = spark.range(2000).select("id", F.when(F.col("id") == 1234, "the needle here").otherwise("plain hay of no note").alias("text")).repartitionByRange(1, "id")
    built = TextIndex.build(rows, F.col("text"), part_bits=6)
    found = built.search(parse_search("needle"))
    assert [r.id for r in found.collect()] == [1234]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    postings = built.masks(parse_search("needle"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in postings  # the filter on grams reaches the scan


def test_grams_of_a_block_in_chunks(monkeypatch):
    rows = [t.encode() for t in texts(64, 9)]
    whole = _grams(rows, np.arange(64, dtype=np.int32))
    monkeypatch.setattr(search_index, "CHUNK", 5)
    cut = _grams(rows, np.arange(64, dtype=np.int32))
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    want = {}
    for i, t in enumerate(rows):
        for j in range(len(t)):
            want[int.from_bytes((t + b"\0\0")[j : j + 3])] = want.get(int.from_bytes((t + b"\0\0")[j : j + 3]), 0) | 1 << i
    assert dict(zip(whole[0].tolist(), whole[1].view(np.uint64).tolist())) == want
    assert [len(x) for x in _grams([b"", b""], np.arange(2, dtype=np.int32))] == [0, 0]


def test_empty_tables_clashes_and_reuse(spark, tmp_path):
    empty = TextIndex.build(spark.createDataFrame([], "id long, text string"), F.col("text"))
    assert empty.search(parse_search("x -y")).count() == empty.search(parse_search("-y")).count() == empty.search([]).count() == 0
    with pytest.raises(ValueError):
        TextIndex.build(spark.range(1).withColumn("__n", F.lit(1)), F.lit("a"))
    spark.createDataFrame([(1, "a long text " * 200_000 + "needle")], "id long, text string").write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    built = index_of(rows, F.col("text"), "t")
    assert index_of(spark.read.parquet(f"{tmp_path}/t"), F.col("text"), "t").path == built.path and built.search(parse_search("needle")).count() == 1
    rows.write.mode("append").parquet(f"{tmp_path}/t")
    fresh = index_of(spark.read.parquet(f"{tmp_path}/t"), F.col("text"), "t")
    assert fresh.path != built.path and fresh.search(parse_search("needle")).count() == 2


def test_facets_and_their_counts(spark):
    from collections import Counter

    from dockmill.operators.explore import facets, search_text
    from dockmill.operators.search_index import comment_facets, wanted_facets

    rng = random.Random(4)
    rows = [(i, t, {rng.choice("12"): rng.randrange(4) for _ in range(2)} if i % 9 else None, [(rng.choice("AB"), rng.choice("xy")) for _ in range(rng.randrange(3))], rng.choice(["p", "q", None])) for i, t in enumerate(texts(300, 8))]
    df = spark.createDataFrame(rows, "id long, comment string, theme_scores map<string,int>, entities array<struct<category:string,label:string>>, submitter_type string").repartition(3)
    df = df.withColumn("search_text", search_text(F.col("comment"))).cache()
    built = TextIndex.build(df, F.col("search_text"), facets=comment_facets(), part_bits=6)
    for query, chosen in itertools.product(["", "them -the", "t", "-no"], [{}, {"themes": ["1", "9"]}, {"themes": ["2"], "max_score": 1, "types": ["p"]}, {"entities": [("A", "x"), ("B", "y")]}, {"types": ["zz"]}]):
        tokens = parse_search(query)
        want = facets(df, tokens=tokens, **chosen).select("id", "submitter_type").collect()
        assert sorted(r.id for r in built.search(tokens, wanted_facets(**chosen)).collect()) == sorted(r.id for r in want)
        counted = {r.value: r.n for r in built.counts("type", tokens, wanted_facets(**chosen)).collect()}
        assert counted == {k: n for k, n in Counter(r.submitter_type for r in want).items() if k}
