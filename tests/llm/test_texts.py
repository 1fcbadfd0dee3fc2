"""BPE, PII, language, quality, sharding: brute force, round trips, held-out accuracy."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from dockmill.llm.bpe import EncodedText, PrefixTable, encode_frame, encoder_of, read_ranks
from dockmill.llm.langid import marginal_shares, predict_frame, train
from dockmill.llm.pii import KINDS, find_spans, mask, sanitise
from dockmill.llm.quality import MEASURES, fit, judge, measures
from dockmill.llm.sharding import assign_shards, communication_matrix, write_shards

VOCABULARY = P.path("byte_bpe_50k.tiktoken")
with open(VOCABULARY, "rb") as f:
    DATA = f.read()
OWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(DATA), special_tokens={})
LETTERS = "ab the ing's'll\n\t  \xa0 \x1c\x85é日本😀12½.,!#-ÄßñTHEre "


def some(rng, n, letters=LETTERS):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(n)))


def test_ids_are_the_librarys():
    e, rng = encoder_of(DATA, P.PATTERN), random.Random(1)
    for _ in range(2000):
        s = some(rng, 60) if rng.random() < 0.7 else some(rng, 90, "aeinst")
        ids = e.encode(s)
        assert ids == OWN.encode_ordinary(s) == e.plain(s) and e.decode(ids) == s.encode()


def test_appends_and_edits():
    e, rng = encoder_of(DATA, P.PATTERN), random.Random(2)
    for _ in range(500):
        s, n = some(rng, 60), some(rng, 6)
        a = rng.randrange(len(s) + 1)
        b = min(len(s), a + rng.randrange(4))
        doc = EncodedText(e, s)
        doc.replace(a, b, n)
        assert doc.ids() == OWN.encode_ordinary(s[:a] + n + s[b:])
        doc.append(n)
        assert doc.ids() == OWN.encode_ordinary(s[:a] + n + s[b:] + n)
        table = PrefixTable(e, s.encode())
        table.replace(min(a, len(s.encode())), min(b, len(s.encode())), n.encode())
        assert table.last == PrefixTable(e, table.data).last
    long = PrefixTable(e, b"abcdefgh" * 200)
    assert long.replace(100, 101, b"xy") < 400


def test_encode_frame(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (3, "", "y"), (4, "é" * 50_000, "z"), (5, " \n  lead", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = encode_frame(df, "text", VOCABULARY, P.PATTERN).collect()
    want = Counter((i, tuple(OWN.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows)
    assert Counter((r.doc_id, tuple(r.token_ids), r.decoded_sha256) for r in got) == want
    assert all(r.n_tokens == len(r.token_ids) for r in got)
    assert encode_frame(df.limit(0), "text", VOCABULARY, P.PATTERN).count() == 0


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    ok = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.group().split(".")),
        "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)),
        "phone": lambda m: 8 <= len(digits(m)) <= 15,
    }
    return {k: [m.span() for m in BASE[k].finditer(text) if ok[k](m)] for k in KINDS}


def test_spans_match_the_patterns():
    rng = random.Random(4)
    pieces = ["a@b.c", "@", "a_b@c-d.e.f", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111111", "+1 (017) 555-7713", "+", "12", " ", ".", "-", "é", "x", "\n", "_", "001.02.3.0255"]
    for _ in range(4000):
        s = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert find_spans(s) == brute_spans(s), s
    assert find_spans("9" * 200_000 + "@" + "a" * 200_000)["email"] == []  # linear


def test_disclosing_terms_and_masks(spark):
    rows = [(i, f"filler{i} word Zorblat jane@x.org common text {i}", "k") for i in range(6)] + [(100 + i, "common text word without any", "k") for i in range(60)]
    rows += [(200, None, None), (201, "", "k"), (0, "filler0 word Zorblat jane@x.org common text 0", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sanitise(df, "text", ["doc_id", "text"])
    shown = got.withColumn("masked", mask(F.col("text"), F.col("spans"))).collect()
    assert len(shown) == len(rows)
    hit = [r for r in shown if r.n_email]
    assert len(hit) == 7 and all("Zorblat" not in r.masked and "<EMAIL>" in r.masked and "<TERM>" in r.masked and "common text" in r.masked for r in hit)
    assert all(r.masked == r.text and not r.spans for r in shown if not r.n_email)
    assert {r.base_sha256 for r in shown if not r.n_email} == {hashlib.sha256(b"").hexdigest()}
    assert sanitise(df.limit(0), "text", ["doc_id"]).count() == 0
    over = spark.createDataFrame([("ab 1.2.3.4 cd", "ip:3:10,term:3:5,term:11:13")], "t string, s string")
    assert over.select(mask(F.col("t"), F.col("s"))).first()[0] == "ab <IP> <TERM>"


SYLLABLES = {"en": ["the", "and", "ing", "tion", "er"], "de": ["der", "und", "sch", "keit", "ü"], "es": ["el", "que", "ción", "ado", "ñ"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def languages():
    rng = random.Random(6)
    return train([(prose(rng, k, 60), k) for k in SYLLABLES for _ in range(40)], steps=60)


def test_held_out_accuracy(spark, languages):
    rng = random.Random(7)
    rows = [(i, prose(rng, k, rng.choice((3, 30, 500))), k) for i, k in enumerate(list(SYLLABLES) * 30)]
    mixed = prose(rng, "de", 70) + " " + prose(rng, "en", 30)
    rows += [(900, None, None), (901, "123 !!", None), (902, mixed, "de"), (902, mixed, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in predict_frame(df, "text", ["doc_id"], languages).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in rows if i < 900) >= 88
    assert (got[900].lang_pred, got[900].score, got[901].lang_pred) == ("und", 0.0, "und")
    assert got[902].lang_pred == "de" and 0.6 < got[902].score < 0.8
    assert predict_frame(df.limit(0), "text", ["doc_id"], languages).count() == 0
    assert train([]).predict(["a"]) == [("und", 0.0)]


def test_blocks_equal_a_plain_pass():
    rng = np.random.default_rng(0)
    table, trans = rng.normal(size=(20, 3)).astype(np.float32), rng.normal(size=(3, 3))
    rows = [rng.integers(0, 20, n) for n in (1, 63, 64, 65, 300)]
    got = marginal_shares(table, trans, rows)
    for r, g in zip(rows, got, strict=True):
        e, step = np.exp(table[r].astype(float)), np.exp(trans)
        a, b = np.empty_like(e), np.empty_like(e)
        v = np.full(3, 1 / 3)
        for i in range(len(r)):
            v = (v @ step) * e[i]
            v = a[i] = v / v.sum()
        v = np.full(3, 1 / 3)
        for i in range(len(r) - 1, -1, -1):
            b[i] = v
            v = step @ (e[i] * v)
            v = v / v.sum()
        m = a * b
        assert np.allclose(g, (m / m.sum(1, keepdims=True)).mean(0))


def brute_measures(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    c, covered, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered)


def test_measures_and_posteriors(spark):
    rng = random.Random(9)
    good = [" ".join(rng.choice(["the", "of", "house", "river", "and", "garden.", "stone", "to", "window", "light.", f"n{rng.randrange(999)}"]) for _ in range(120)) for _ in range(60)]
    junk = [" ".join(f"{rng.choice('XYZW')}{rng.randrange(99)}###" for _ in range(120)) for _ in range(15)] + [" ".join("QWE RTY!! UIO".split()[rng.randrange(3)] + "$$" for _ in range(80)) for _ in range(10)]
    odd = [None, "", " \n\t ", "a", "a b c a b c", "x\nx\n \nx\ny", "é\u00a0ü b", "\x0b\x0c a", "w " * 3000]
    rows = [(i, t, "k") for i, t in enumerate([*good, *junk, *odd, odd[4]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in judge(df, F.col("text")).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert tuple(got[i][m] for m in MEASURES) == brute_measures(t), t
        n, _, _, _, repeated = brute_measures(t)
        assert got[i].base_failed == (n < 50 or 100 * repeated > 50 * n)
    assert all(got[i].kept for i in range(60) if not got[i].base_failed)
    assert not any(got[i].kept for i in range(60, 85))
    assert judge(df.limit(0), F.col("text")).count() == 0


def test_windows_with_equal_hashes_are_told_apart(spark):
    """Whatever the hash does, repeats are those of the words."""
    rng = random.Random(9)
    texts = ["a b c x y z a b c", "a b c d e f g a b c q a b c", ""] + [" ".join(rng.choice("abcd") for _ in range(rng.randrange(30))) for _ in range(60)]

    def brute(text):
        w = text.split()
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)})

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for hashed in (F.xxhash64, lambda a, b, c: F.length(a).cast("long"), lambda a, b, c: F.ascii(a).cast("long")):
        got = {r.id: r.n_repeat_words for r in measures(df, F.col("text"), ["id"], hashed).collect()}
        assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_em_finds_a_poor_rule():
    rng, counts = random.Random(1), Counter()
    for _ in range(5000):
        y = rng.random() < 0.75
        votes = [(1 if (y if rng.random() < a else not y) else -1) if rng.random() < 0.9 else 0 for a in (0.95, 0.9, 0.9, 0.6)]
        counts[sum((v + 1) * 3**j for j, v in enumerate(votes))] += 1
    prior, accuracy = fit(dict(counts), 4)
    assert abs(prior - 0.75) < 0.05 and accuracy[0][0] > 0.9 > 0.75 > accuracy[3][0]
    assert fit({}, 4)[0] == 0.8


def test_shards(spark, tmp_path):
    rows = [(i if i % 50 else None, f"t{i % 7}", "s") for i in range(1003)] + [(5, "t5", "s")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = assign_shards(df, [F.col("doc_id"), F.col("text")], 24, n_parts=16, n_cells=4).collect()
    by = Counter(r.shard for r in got)
    assert len(got) == len(rows) and len(by) == 24 and max(by.values()) - min(by.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in by.items())
    assert assign_shards(df.limit(0), [F.col("doc_id")], 24, n_parts=4, n_cells=2).count() == 0
    write_shards(df.select("doc_id", "text"), [F.col("doc_id"), F.col("text")], 3, f"file://{tmp_path}/out", n_parts=8, n_cells=2)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == len(rows)


def test_matrix_margins_and_law():
    counts = np.array([0, 10, 30, 5, 55])
    m = communication_matrix(counts, 7, 1)
    assert (m.sum(1) == counts).all() and m.sum(0).max() - m.sum(0).min() <= 1
    means = np.mean([communication_matrix(np.array([40, 60]), 4, s)[0] for s in range(400)], axis=0)
    assert np.allclose(means, 10, atol=0.5)
