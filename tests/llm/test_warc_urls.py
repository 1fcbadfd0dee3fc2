import base64
import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from dockmill.llm.urls import Boosted, Rules, filter_urls, parse, train
from dockmill.llm.warc import coalesce_ranges, read_records, write_archives

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def test_round_trip(spark):
    rows = [(3, "http://a/ü?x=1 2", "é<html>"), (1, "http://b", "é<html>"), (2, None, None), (5, "u\r\nX: y", ""), (4, "http://c", "x" * 300_000), (4, "http://c", "x" * 300_000), (None, "n", "é<html>"), (None, "n", "alone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit("clash"))
    index = write_archives(df, "page_id", "url", "html", file_bytes=200_000)
    assert index.count() == len(rows) and index.select("file").distinct().count() >= 1
    got = read_records(index, max_gap=10, block_bytes=1000).collect()
    key = lambda p: base64.b32encode(hashlib.sha1(p.encode()).digest()).decode()
    want = sorted(((None if i is None else str(i)), u, key(h or ""), len((h or "").encode())) for i, u, h in rows if i is not None)
    assert sorted((r.id, r.url, r.payload_digest, r.payload_bytes) for r in got if r.id is not None) == sorted(want, key=lambda x: (x[0], x[1] or ""))
    kinds = {(r.id, r.url): (r.record_type, r.refers_to) for r in got}
    assert kinds["3", "http://a/ü?x=1 2"] == ("revisit", "1") and kinds["1", "http://b"] == ("response", None)
    assert kinds["5", "u\r\nX: y"] == ("revisit", "2") and kinds[None, "n"] in (("revisit", "1"), ("response", None))
    assert {r.payload.decode() for r in got if r.id == "1"} == {"é<html>"}
    one = read_records(index.where("id = '4'")).collect()
    assert len(one) == 2 and {r.record_type for r in one} == {"response"}
    small = read_records(write_archives(df, "page_id", "url", "html", least_revisit=8)).where("record_type = 'revisit'").collect()
    assert {r.id for r in small} == {"3", None}
    assert write_archives(df.limit(0), "page_id", "url", "html").count() == 0


def test_ranges():
    assert coalesce_ranges([(100, 10), (0, 10), (15, 5), (115, 1)], 5) == [(0, 20, [(0, 10), (15, 5)]), (100, 116, [(100, 10), (115, 1)])]
    assert coalesce_ranges([], 5) == []


def test_hosts_and_rules():
    assert parse("HTTP://A.ORG/P?q#f") == ("a.org", "/P") and parse("x://h?q/y") == ("h", "") and parse(None) == ("", "") and parse("no") == ("", "")
    rules = Rules(RULES)
    assert rules.find("a.example.org", "/es/1") == ("example.org/es/", "block") and rules.find("example.org", "/en/12") == ("example.org/en/1", "block")
    assert rules.find("xexample.org", "/es/1") == ("org/", "allow") and rules.find("a.net", "/") == (None, None) and rules.find("b.org", "") == (None, None)

    def brute(host, path):
        fits = [(r, v) for r, v in RULES if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r.split("/", 1)[1])]
        return max(fits, key=lambda x: len(x[0]), default=(None, None))

    rng = random.Random(3)
    for _ in range(500):
        host = ".".join(rng.choice(["a", "example", "org", "com", "net"]) for _ in range(rng.randrange(1, 4)))
        path = "".join(rng.choice(["/es", "/en", "/1", "/fr/", "/de/", ""]) for _ in range(3))
        assert rules.find(host, path) == brute(host, path)


def test_every_url_is_judged(spark):
    urls = [f"http://{h}.example.{t}/{p}/{n}" for n, (h, t, p) in enumerate((h, t, p) for h in "abcdefgh" for t in ("com", "org", "net") for p in ("de", "fr", "es", "en"))] + [None, "", "http://"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("verdict", F.lit("clash"))
    got = filter_urls(df, "url", ["page_id"], RULES).collect()
    assert len(got) == len(urls) and {r.verdict for r in got} <= {"allow", "block"}
    assert all(r.verdict == Rules(RULES).find(r.host, r.path)[1] for r in got if r.rule)
    none = filter_urls(df, "url", ["page_id"], []).collect()
    assert {r.verdict for r in none} == {"allow"}
    assert filter_urls(df.limit(0), "url", ["page_id"], RULES).count() == 0


def test_trees_learn_held_out_urls():
    rng = random.Random(0)
    urls, bad = [], []
    for _ in range(1500):
        y = rng.random() < 0.4
        tail = "".join(rng.choice("0123456789") for _ in range(12)) if y else rng.choice(["news", "about", "team"])
        urls.append(f"http://{rng.choice('abc')}.site.{rng.choice(['com', 'net'])}/{tail}" + ("?a=1&b=2" if rng.random() < 0.3 else ""))
        bad.append(y)
    lexical, model = train(urls[:1000], bad[:1000])
    p = model.predict(lexical.matrix(urls[1000:]))
    assert ((p > 0.5) == np.array(bad[1000:])).mean() > 0.97
    assert math.isclose(Boosted().fit(np.zeros((5, 2)), np.zeros(5)).predict(np.zeros((1, 2)))[0], 1e-4, rel_tol=0.01)
