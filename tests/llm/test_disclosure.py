"""What discloses an entity, by document: against counts in plain Python."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from dockmill.llm.pii import find_spans, mask, sanitise


def brute(texts):
    shown, having = [], []
    for text in texts:
        spans = [s for of in find_spans(text).values() for s in of]
        at, words = 0, []
        for w in text.split(" "):
            if w and not any(a < at + len(w) and at < b for a, b in spans):
                words.append((at, at + len(w), w))
            at += len(w) + 1
        shown.append(words)
        having.append({text[a:b].lower() for a, b in spans})
    n, terms, entities, both = len(texts), Counter(), Counter(), Counter()
    for words, of in zip(shown, having, strict=True):
        own = {w for _, _, w in words}
        terms.update(own)
        entities.update(of)
        both.update((w, e) for w in own for e in of)
    bad = {(w, e) for (w, e), k in both.items() if k >= 3 and math.log(k * n / (terms[w] * entities[e])) >= 0.95 * -math.log(entities[e] / n)}
    return [",".join(f"term:{a}:{b}" for a, b, w in words if any((w, e) in bad for e in of)) for words, of in zip(shown, having, strict=True)]


def test_far_and_repeated_terms_are_masked(spark):
    far = "Zorblat wrote " + "common words of a letter " * 6
    texts = [f"{far}jane@x.org and Zorblat" if i % 2 else f"jane@x.org {far}and so on" for i in range(6)] + ["common words of a letter wrote and so on"] * 60
    got = sanitise(spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string"), "text", ["doc_id", "text"])
    masked = {r.doc_id: r.m for r in got.select("doc_id", mask(F.col("text"), F.col("spans")).alias("m")).collect()}
    assert all("Zorblat" not in m and "jane" not in m for m in masked.values())
    assert masked[1] == "<TERM> wrote " + "common words of a letter " * 6 + "<EMAIL> and <TERM>" and masked[9] == texts[9]


def test_equal_to_brute_force(spark):
    rng = random.Random(5)
    names, entities = [f"name{i}" for i in range(25)], [f"m{i}@x.org" for i in range(8)] + ["+1 555 2000 30", "10.0.0.1"]
    texts = ["name3 m3@x.org x555 555"] * 4
    for _ in range(400):
        k = rng.randrange(40)
        words = rng.choices(["a", "b", "c", "555", *names[10:]], k=rng.randrange(14))
        if k < 10:
            words += [entities[k]] * rng.randrange(1, 3) + [names[k]] * rng.choice((0, 1, 1, 2)) + rng.choices(entities, k=rng.randrange(2))
        rng.shuffle(words)
        texts.append(" ".join(words))
    got = sanitise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text", ["doc_id"])
    found = {r.doc_id: ",".join(s for s in r.spans.split(",") if s.startswith("term:")) for r in got.collect()}
    want = brute(texts)
    assert sum(map(bool, want)) > 20 and found == dict(enumerate(want))
