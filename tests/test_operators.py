"""Operators on small tables, against golden cases and plain Python models."""

import pytest
from pyspark.sql import functions as F

from dockmill.functions import text as t
from dockmill.operators import batching, clusters, collection, entities, explore, similarity
from dockmill.operators.generate import PARTS, PROVIDERS, generate, generate_multimodal
from dockmill.operators.stages import condense, extract_content, summarize, summarize_sections, theme_groups, transcribe, transcribe_files
from dockmill.plans.ordering import numbered
from dockmill.plans.schema import TABLES, open_store
from dockmill.sources import api, bulk, export
from dockmill.sources.store import Store
from dockmill.streaming.ingest import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text_functions(spark):
    L = F.lit
    assert one(spark, t.word_count(L(" a b  c "))) == 3 and one(spark, t.word_count(L(None).cast("string"))) == 0
    assert one(spark, t.split_count(L(""))) == 1
    assert one(spark, t.weak(L("No comment on this"))) and one(spark, t.weak(L("Not addressed")))
    assert not one(spark, t.weak(L("no " + "word " * 20)))
    assert one(spark, t.json_body(L('x ```json\n{"a":1}\n``` y'))) == '{"a":1}' and one(spark, t.json_body(L("none"))) is None
    assert one(spark, t.cut_description(L("Harm to u.s"))) and not one(spark, t.cut_description(L("A. B")))
    assert one(spark, t.first_sentence(L("Harm to U.S. Citizens. More"))) == "Harm to U.S. Citizens"
    assert one(spark, t.features(L("A bb cc dd"), "both")) == ["n3:bb cc dd"] and one(spark, t.features(L(""), "both")) == []
    assert one(spark, t.bullets(L("x\n - a\n  - b"))) == ["a", "b"] and one(spark, t.unquote(L('"a"'))) == "a"
    assert one(spark, t.profile(L("- **Name (x):** Ann\n- **Name x:** Bob"))) == {"namex": "Bob"}
    assert one(spark, t.extension(L("http://x/a.PDF?y=1.z"))) == "pdf" and one(spark, t.leading_int(L("12 pages"))) == 12
    text = "intro\n### CORE POSITION\nold\n### core position\nnew\n### WHAT\nx"
    assert one(spark, t.sections(L(text))) == {"corePosition": "new"}
    errors = one(spark, t.section_errors(L(text)))
    assert len(errors) == 3 and "ONE-LINE SUMMARY" in errors[2] and "WHAT" in errors[1]


def test_word_boundaries(spark):
    docs = spark.createDataFrame([(1, "éCMS"), (2, "xCMSy"), (3, "a CMS."), (4, "a C++b C++ d"), (5, None)], "id int, content string")
    terms = spark.createDataFrame([("A", "CMS", ["CMS"]), ("B", "cpp", ["C++"])], "category string, label string, terms array<string>")
    want = {(1, "CMS"), (3, "CMS"), (4, "cpp")}
    assert {(r.id, r.label) for r in entities.annotate(docs, "id", "content", terms).collect()} == want
    entities.MAX_TERMS, kept = 0, entities.MAX_TERMS
    assert {(r.id, r.label) for r in entities.annotate(docs, "id", "content", terms).collect()} == want
    entities.MAX_TERMS = kept


def test_dictionary_against_the_regex(spark):
    """Every kind of edge, in texts made of the same few characters."""
    import random
    import re

    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("ab+- .é") for _ in range(n))
    terms = list({x for x in (text(rng.randrange(1, 5)) for _ in range(60)) if x})
    docs = [(i, text(rng.randrange(12))) for i in range(80)]
    asked = spark.createDataFrame(docs, "id int, content string"), "id", "content", spark.createDataFrame([("c", x, [x]) for x in terms], "category string, label string, terms array<string>")
    found = entities.annotate(*asked)
    word = re.compile("[A-Za-z0-9_]")

    def pattern(x):
        return ("(?<!%s)" if word.match(x[0]) else "(?<=%s)") % word.pattern + re.escape(x) + ("(?!%s)" if word.match(x[-1]) else "(?=%s)") % word.pattern

    want = {(i, x) for i, d in docs for x in terms if re.search(pattern(x), d)}
    assert {(r.id, r.label) for r in found.collect()} == want and len(want) > 20
    entities.MAX_CHARS, kept = 0, entities.MAX_CHARS
    assert {(r.id, r.label) for r in entities.annotate(*asked).collect()} == want
    entities.MAX_CHARS = kept


def serial_leaders(rows, threshold):
    leaders, out = [], {}
    for k, f in rows:
        best = None
        for lead, g in leaders:
            u = len(set(f) | set(g))
            s = len(set(f) & set(g)) / u if u else 0
            if f and s >= threshold:
                first = min(i for i, x in enumerate(f) if x in g)
                best = min(best or (2,), (-s, first, lead))
        out[k] = best[2] if best else k
        if not best:
            leaders.append((k, f))
    return out


def test_leaders_match_the_serial_loop(spark):
    import random

    rng = random.Random(5)
    rows = []
    for k in range(80):
        base = [f"f{i}" for i in range(rng.choice((0, 12)))] if k % 2 else [f"g{i}" for i in range(10)]
        for _ in range(rng.randrange(4)):
            if base:
                base[rng.randrange(len(base))] = f"x{rng.randrange(6)}"
        rows.append((k, list(dict.fromkeys(base))))
    df = spark.createDataFrame(rows, "k long, f array<string>")
    got = {r.k: r.leader for r in similarity.leaders(df, "k", "f", 0.6).collect()}
    assert got == serial_leaders(rows, 0.6)
    pairs = {(r.a, r.b) for r in similarity.similar_pairs(df, "k", "f", 0.6).collect()}
    want = {(a, b) for a, x in rows for b, y in rows if a < b and x and y and len(set(x) & set(y)) / len(set(x) | set(y)) >= 0.6}
    assert pairs == want


def test_batches(spark):
    rows = spark.createDataFrame([("a", 1, 60), ("a", 2, 60), ("a", 3, 60), ("b", 1, 500), ("b", 2, 1)], "g string, o int, w long")
    got = {(r.g, r.o): r.batch for r in batching.sequential_batches(rows, "g", "o", "w", 0, 100).collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("a", 3): 3, ("b", 1): 1, ("b", 2): 2}
    assert {r.batch for r in batching.sequential_batches(rows, "g", "o", "w", 1000, 100).collect()} == {1}
    even = batching.even_batches(rows, "g", "o", "w", 100).join(rows, ["g", "o"]).groupBy("g", "batch").agg(F.sum("w").alias("w")).where("g = 'a'").collect()
    assert sorted(r.w for r in even) == [60, 120]


def test_percentile_and_band(spark):
    p = lambda xs: [r.percentile for r in explore.percentile(spark.createDataFrame([(x,) for x in xs], "w int"), "w").orderBy("w").collect()]
    assert p([1, 1, 2, 5]) == [0, 0, 67, 100] and p([7]) == [100]
    hits = spark.createDataFrame([(i, "c", "x") for i in range(101)] + [(0, "c", "y"), (0, "c", "z"), (1, "c", "z")], "id int, category string, label string")
    assert {r.label for r in entities.frequency_band(hits, "id", spark.createDataFrame([(200,)], "n long")).collect()} == {"z"}


def test_empty_and_limits(spark):
    s = spark.createDataFrame([], "comment_id string, status string, attempt_count int")
    r = collection.status_summary(s).first()
    assert (r.total, r.completed) == (0, None)
    rows = spark.createDataFrame([(f"i{k}", k) for k in range(5)], "id string, ord long")
    stored = rows.limit(0)
    assert collection.only_new(rows, stored, "id", 2).count() == 2
    assert collection.only_new(rows, spark.createDataFrame([(f"s{k}", k) for k in range(10)], rows.schema), "id", 5).count() == 0
    assert explore.representatives_only(spark.createDataFrame([(1, None)], "id int, is_representative boolean")).count() == 1


def test_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Document ID,Comment,Page Count,Attachment Files\nD1,"two\nlines ""q""",3 pages,"http://x/a.pdf, http://x/b"\n,plain,x,\n')
    rows = bulk.scan_csv(spark, str(tmp_path / "c.csv"))
    got = {r.id: r.attributes_json for r in bulk.comments_from_csv(rows).collect()}
    assert got == {"D1": '{"id":"D1","comment":"two\\nlines \\"q\\"","pageCount":3}', "row2": '{"comment":"plain"}'}
    files = bulk.attachments_from_csv(rows, F.col("Document ID"), F.col("Attachment Files")).collect()
    assert [(f.id, f.format, f.file_name) for f in files] == [("D1-att1", "pdf", "a.pdf"), ("D1-att2", "bin", "b")]


def test_api_replay(spark):
    files = lambda *fs: {"data": {"attributes": {"fileFormats": list(fs)}}}
    comment = lambda attributes, *ids: {"data": {"attributes": attributes, "relationships": {"attachments": {"data": [{"id": i} for i in ids]}}}}
    pages = {
        "b/documents/D": {"data": {"attributes": {"objectId": "o", "title": "T", "docketId": "K"}}},
        "b/comments?filter[commentOnId]=o&page[size]=250&page[number]=1": {"data": [{"id": "1"}, {"id": "2"}, {"id": "3"}]},
        "b/comments/1?include=attachments": comment({"comment": "x"}, "a"),
        "b/attachments/a?include=fileFormats": files({"format": "PDF", "fileUrl": "u", "size": 1}, {"fileUrl": None}, {"fileFormat": "txt", "downloadUrl": "v", "formatId": "f"}),
        "b/comments/2?include=attachments": comment({}, "a", "g"),
        "b/attachments/g?include=fileFormats": files({"format": "pdf", "fileUrl": "gone"}),
        "b/comments/3?include=attachments": {"data": {"attributes": {}}},
        "u": b"%PDF-\xff",
        "v": b"",
    }
    got = {r.id: r for r in api.load_document(spark, "b", "D", api.Replay(pages)).collect()}
    assert got.keys() == {"1", "3"} and got["3"].attachments == []
    assert [(f.id, f.format, f.file_name, f.size, bytes(f.blob_data)) for f in got["1"].attachments] == [("a", "pdf", "a.pdf", 7 - 1, b"%PDF-\xff"), ("f", "txt", "a.txt", None, b"")]
    ids = spark.createDataFrame([("1",), ("2",)], "id string")
    assert {r.id: [f.blob_data for f in r.attachments] for r in api.fetch_details(ids, "b", api.Replay(pages), download=False).collect()} == {"1": [None, None], "2": [None, None, None]}
    documents = spark.createDataFrame([("D",), ("E",), ("F",)], "document_id string")
    meta = api.fetch_metadata(documents, "b", api.Replay(pages), documents.where("document_id = 'F'")).collect()
    assert [(m.document_id, m.title, m.docket_id, m.agency_id) for m in meta] == [("D", "T", "K", None)]


def test_http_reads_bytes_and_waits():
    import io
    import urllib.error

    answers, waits = [urllib.error.HTTPError("u", 429, "busy", {}, None), b'{"a": 1}', b"%PDF-\xff"], []

    def open_(request):
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return io.BytesIO(answer)

    fetch = api.Http("k", sleep=waits.append, open_=open_)
    assert fetch("http://x/u") == {"a": 1} and fetch.download("http://x/f") == b"%PDF-\xff" and waits == [5.0]


def test_store_and_stream(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    assert not store.exists("t")
    store.upsert("t", spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), ["id"])
    assert {(r.id, r.v) for r in store.upsert("t", spark.createDataFrame([(2, "c")], "id int, v string"), ["id"]).collect()} == {(1, "a"), (2, "c")}
    with pytest.raises(ValueError):
        store.insert("t", spark.createDataFrame([(1, "z")], "id int, v string"), ["id"])
    store.insert_ignore("t", spark.createDataFrame([(1, "z"), (3, "d")], "id int, v string"), ["id"])
    assert {r.id for r in store.delete("t", F.col("id") == 2).collect()} == {1, 3}
    twice = spark.createDataFrame([(7, "old"), (7, "new")], "id int, v string").coalesce(1)
    assert [r.v for r in store.upsert("t", twice, ["id"]).where("id = 7").collect()] == ["new"]
    assert [r.v for r in store.upsert("t", twice, ["id"], order=F.col("v")).where("id = 7").collect()] == ["old"]
    store.delete("t", F.col("id") == 7)
    stale = Store(spark, store.root)
    stale._manifests = lambda table, found=store._manifests("t"): found
    store.delete("t", F.lit(False))
    with pytest.raises(RuntimeError, match="another writer"):
        stale.delete("t", F.lit(True))
    before, after = store.vacuum("t", 1)
    assert after < before and len(store.versions("t")) == 1 and store.read("t").count() == 2
    (tmp_path / "in").mkdir()
    for n, v in enumerate(("x", "y")):
        (tmp_path / "in" / f"{n}.json").write_text(f'{{"id": 3, "v": "{v}"}}\n{{"id": {n + 10}, "v": "n"}}\n')
        ingest(spark, str(tmp_path / "in"), "id int, v string", store, "t", ["id"], str(tmp_path / "cp"))
        ingest(spark, str(tmp_path / "in"), "id int, v string", store, "b", ["id"], str(tmp_path / "cb"), buckets=5)
    assert {(r.id, r.v) for r in store.read("t").collect()} == {(1, "a"), (3, "y"), (10, "n"), (11, "n")}
    parts = store.manifest("b")["parts"]
    store.upsert("b", spark.createDataFrame([(3, "z")], "id int, v string"), ["id"])
    changed = {b for b, p in store.manifest("b")["parts"].items() if parts.get(b) != p}
    assert len(changed) == 1 and {(r.id, r.v) for r in store.read("b").collect()} == {(3, "z"), (10, "n"), (11, "n")}
    store.vacuum("b")
    assert {(r.id, r.v) for r in store.read("b").collect()} == {(3, "z"), (10, "n"), (11, "n")}
    assert store.clear("b").count() == 0


def test_generation_and_stages(spark):
    prompts = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "id int, prompt string")
    asked, fresh = generate(prompts, "prompt", "stub")
    assert fresh.count() == 2 and asked.where("result is null").count() == 0
    again, more = generate(prompts, "prompt", "stub", fresh)
    assert more.count() == 0 and again.count() == 3
    stale = fresh.withColumn("result", F.when(F.col("prompt_hash") == fresh.first().prompt_hash, "").otherwise("no json"))
    both, renewed = generate(prompts, "prompt", "stub", stale.unionByName(stale), post=t.valid_json)
    assert both.count() == 3 and renewed.count() == 2 and both.where("parsed is null").count() == 0
    kept, none = generate(prompts, "prompt", "stub", stale)
    assert sorted(r.id for r in kept.where("result = 'no json'").collect()) in ([1, 2], [3]) and none.count() == 1
    parts = spark.createDataFrame([(1, [("a/b", None, b"12")]), (2, [("a/b", None, b"34")]), (3, [("a/b", None, b"12")])], f"id int, parts {PARTS}")
    seen, new = generate_multimodal(parts, "parts", "stub")
    assert new.count() == 2 and len({r.result for r in seen.collect()}) == 2
    comments = spark.createDataFrame([("a", "text"), ("b", "text")], "id string, content string")
    files = spark.createDataFrame([("a", "f1", 1, "pdf", b"x"), ("a", "f1", 2, "txt", b"y"), ("a", "f2", 3, "odt", b"z")], "comment_id string, id string, ord int, format string, blob_data binary")
    read, _ = transcribe_files(comments, files, "stub", ["pdf"])
    assert {(r.id, r.status) for r in read.collect()} == {("a", "completed"), ("b", "completed")}
    done, _ = transcribe(comments, "stub")
    assert {r.status for r in done.collect()} == {"completed"}
    assert {r.status for r in condense(done, "stub")[0].collect()} == {"failed"}  # the stub writes no sections
    themes = spark.createDataFrame([("1", "A", "g"), ("1.10", "B", "g"), ("1.2", "C", "g"), ("2", "D", None)], "code string, description string, detailed_guidelines string")
    assert {r.top: r.text for r in theme_groups(themes).collect()}[1] == "1: A. g\n1.2: C. g\n1.10: B. g"
    rows, processed, _ = extract_content(comments, themes, "stub")
    assert rows.count() == 0 and processed.count() == 2
    PROVIDERS["ids"] = lambda prompt: '{"commentId": "-0232", "more": [{"commentIds": ["0241", "9"]}]}'
    extracts = spark.createDataFrame([("1", f"X-{i:04d}", {"positions": ["a"]}, 2) for i in (232, 241)] + [("2", "X-0001", {"positions": ["b"]}, 1)], "theme_code string, comment_id string, extract map<string,array<string>>, cluster_size int")
    known = extracts.select(F.col("comment_id").alias("id"))
    found = summarize(extracts, "ids", known, least=2).collect()
    assert [(r.theme_code, r.comment_count, r.sections) for r in found] == [("1", 4, '{"commentId": "X-0232", "more": [{"commentIds": ["X-0241", "9"]}]}')]
    assert summarize(extracts, "stub", known, batch_words=1).count() == 2
    scored = extracts.select("theme_code", "comment_id", F.create_map(F.lit("corePosition"), F.lit("p " * 9)).alias("structured_sections"))
    assert {(r.theme_code, r.comment_count) for r in summarize_sections(scored, "stub", batch_words=5, width=2).collect()} == {("1", 2), ("2", 1)}


def test_clusterings_are_stored(spark, tmp_path):
    store = open_store(spark, f"file://{tmp_path}/s")
    assert set(TABLES) == {n for n in TABLES if store.exists(n)} and open_store(spark, store.root).read("comments").count() == 0
    with pytest.raises(LookupError):
        clusters.representative_ids(store.read("clustering_status"), store.read("comment_cluster_membership"))
    rows = spark.createDataFrame([("a", "a", 3), ("b", "a", 9), ("c", "a", 9), ("d", "d", 1), ("e", "d", 2)], "k string, leader string, n int")
    clusters.store_clustering(store, rows, F.col("n"), 3, 0.8)
    members = {r.comment_id: (r.cluster_id, r.is_representative) for r in store.read("comment_cluster_membership").collect()}
    assert members == {"a": (1, False), "b": (1, True), "c": (1, False), "d": (2, True), "e": (3, True)}
    assert {r.comment_id for r in clusters.representative_ids(store.read("clustering_status"), store.read("comment_cluster_membership")).collect()} == {"b", "d", "e"}


def test_first_match_clusters(spark):
    import random

    rng = random.Random(2)
    rows = [(g, o, sorted({rng.choice("abcde") for _ in range(rng.randrange(5))}), rng.randrange(9)) for g in "xy" for o in range(40)]
    got = {(r.g, r.o): r.cluster for r in clusters.first_match_clusters(spark.createDataFrame(rows, "g string, o int, w array<string>, n int"), "g", "o", "w", "n", 0.5).collect()}
    want = {}
    for g in "xy":
        members: list[list] = []
        for _, o, w, n in (r for r in rows if r[0] == g):
            for c, of in enumerate(members):
                longest = of[max(range(len(of)), key=lambda i: of[i][1])][0]
                union = set(w) | set(longest)
                if union and len(set(w) & set(longest)) / len(union) >= 0.5:
                    break
            else:
                c = len(members)
                members.append([])
            members[c].append((w, n))
            want[g, o] = c
    assert got == want


def test_exports(spark, tmp_path):
    import zipfile

    for name, path in export.DOCUMENTS.items():
        if name != "theme_extracts":
            (tmp_path / path).parent.mkdir(exist_ok=True)
            (tmp_path / path).write_text('[{"a": 1}, {"a": 2}]')
    loaded = export.load_documents(str(tmp_path))
    assert loaded["theme_extracts"] == {} and loaded["comments"] == [{"a": 1}, {"a": 2}]
    assert export.scan_document(spark, str(tmp_path), "comments").count() == 2
    (tmp_path / "meta.json").unlink()
    with pytest.raises(OSError):
        export.load_documents(str(tmp_path))
    export.zip_texts(str(tmp_path / "z.zip"), "f", {"B.md": "b", "A.md": "ä"})
    with zipfile.ZipFile(tmp_path / "z.zip") as z:
        assert z.namelist() == ["f/A.md", "f/B.md"] and z.read("f/A.md").decode() == "ä"
    summary = {"executiveSummary": "S", "consensusPoints": [{"text": "t", "supportLevel": "high", "evidence": ["e"]}], "keyQuotations": [], "analyticalNotes": {"complexityLevel": "low"}}
    assert explore.exported_summary(summary, {"analyticalNotes": False}) == "## Executive Summary\nS\n\n## Consensus Points\n- t - high\n  - e"
    assert explore.toggle(["a", "b"], "a") == ["b"] and explore.toggle(["b"], "a") == ["b", "a"]
    with pytest.raises(KeyError):
        explore.comment_toggles(nothing=True)


def test_files_count_in_the_order_of_their_names(spark, tmp_path):
    for name, n in (("b", 1), ("a", 500), ("c", 3)):
        (tmp_path / f"{name}.csv").write_text("Document ID,Comment\n" + "".join(f"{name}{i},x\n" for i in range(n)))
    rows = bulk.scan_csv(spark, str(tmp_path))
    got = [r[0] for r in rows.orderBy("ord").select("Document ID").collect()]
    assert got == [f"{n}{i}" for n, k in (("a", 500), ("b", 1), ("c", 3)) for i in range(k)] and rows.agg(F.max("ord")).first()[0] == 504


def test_numbers_and_codes(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert [r.nr for r in numbered(rows, "nr", "x", start=1).orderBy("x").collect()] == list(range(1, 1001))
    codes = spark.createDataFrame([(c,) for c in ("10", "2", "2.10", "2.9", "2.b", "2.A", "x")], "code string")
    assert [r.code for r in codes.orderBy(t.natural_key(F.col("code"))).collect()] == ["2", "2.9", "2.10", "2.A", "2.b", "10", "x"]
    words = lambda s: F.array(*map(F.lit, s.split())) if s else F.array().cast("array<string>")
    assert one(spark, similarity.jaccard(words("a b"), words("b c"))) == pytest.approx(1 / 3) and one(spark, F.isnan(similarity.jaccard(words(""), words(""), float("nan"))))


def test_budget_reaches_into_the_order(spark):
    import hashlib

    for n, w, budget in ((500, 7, 300), (50, 90, 100), (20, 1, 1000), (30, 0, 0)):
        rows = sorted((hashlib.sha256(str(i).encode()).hexdigest(), w if i % 5 else 3 * w) for i in range(n))
        want, total = set(), 0
        for h, x in rows:
            if total + x > budget and total > 0.9 * budget:
                break
            want.add(h)
            total += x
        got = batching.budget_sample(spark.createDataFrame(rows, "h string, w long"), "w", budget, "h", digits=2)
        assert {r.h for r in got.collect()} == want


def test_deletion_leaves_the_rest_working():
    """Nothing outside the subpackage imports it."""
    import pathlib

    root = pathlib.Path(__file__).parent.parent
    for p in (root / "dockmill").rglob("*.py"):
        if "llm" not in p.parts:
            assert "dockmill.llm" not in p.read_text()
