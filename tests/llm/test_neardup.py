import random
import re

import numpy as np
import pytest

from dockmill.llm.neardup import Sketcher, near_duplicates, shingles


def brute(rows, k, percent):
    """Components by comparing all pairs."""
    sets, ids = [], []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        n = min(k, len(w))
        sets.append({tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set())
        ids.append(i)
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            c = len(sets[a] & sets[b])
            if c and 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
                parent[top(a)] = top(b)
    out = {}
    for a in range(len(rows)):
        group = [ids[b] for b in range(len(rows)) if top(b) == top(a)]
        out[a] = (len(sets[a]), min(group))
    return out


def near_group(rng, n, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("edits", [1, 3])
def test_near_copies_match_brute_force(spark, edits):
    rng = random.Random(edits)
    texts = near_group(rng, 60, edits) + near_group(rng, 30, edits + 1) + ["", None, "one", "one", "ONE two", "a b c"] * 2
    texts += [" ".join(f"y{rng.randrange(300)}" for _ in range(40)) for _ in range(30)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, "doc_id", "text", k=4).collect()}
    want = {rows[a][0]: v for a, v in brute(rows, 4, 80).items()}
    assert got == {i: (n, c if n else i) for i, (n, c) in want.items()}


def test_rows_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "y"), (3, None, "z"), (None, "", None)], "doc_id long, text string, bands string")
    out = near_duplicates(df, "doc_id", "text", carry=["doc_id", "text", "bands"]).collect()
    assert len(out) == 5
    assert [r.component_id for r in out if r.bands in ("x", "y")] == [1, 1, 1]
    assert sum(r.first_of_component for r in out) == 3
    assert near_duplicates(df.limit(0), "doc_id", "text").count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    sketcher = Sketcher(448)
    for n in (1, 2, 7, 60, 3000):
        s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        out = sketcher.sketch(s)
        assert (out != 2**64 - 1).all() and (out == sketcher.sketch(s)).all()
    common = rng.integers(0, 2**63, 800).astype(np.uint64)
    x = np.unique(np.concatenate([common, rng.integers(0, 2**63, 100).astype(np.uint64)]))
    y = np.unique(np.concatenate([common, rng.integers(0, 2**63, 100).astype(np.uint64)]))
    assert abs((sketcher.sketch(x) == sketcher.sketch(y)).mean() - 0.8) < 0.1


def test_short_texts_are_one_shingle():
    assert len(shingles("a b", 4)) == 1 and len(shingles(" \n", 4)) == 0
    assert (shingles("A b", 4) == shingles("a  B ", 4)).all()
