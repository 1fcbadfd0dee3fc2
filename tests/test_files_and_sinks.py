"""Attachment files, report sinks, backfills and cache upkeep."""

import json

import pytest
from pyspark.sql import functions as F

from dockmill.operators import collection
from dockmill.operators.generate import verify_cache
from dockmill.plans import shared
from dockmill.sources import export, files
from dockmill.sources.store import Store


def test_attachment_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.TXT").write_text("héllo")
    (tmp_path / "in" / "b.odt").write_bytes(b"\x00\xff")
    (tmp_path / "c").write_bytes(b"x")
    (tmp_path / "d.txt").write_bytes(b"a\xffb")
    found = files.scan_attachments(spark, str(tmp_path))
    got = sorted((r.format, r.size, r.text) for r in files.extract_text(found).collect())
    assert got == [("", 1, ""), ("odt", 2, ""), ("txt", 3, "a\ufffdb"), ("txt", 6, "héllo")]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b|<", None)], "k string, n int").coalesce(1)
    assert export.markdown_table(df) == "| k | n |\n| - | - |\n| a | 1 |\n| b\\|< |  |".replace("| - | - |", "| - | - |")
    many = spark.range(30)
    assert export.markdown_table(many, most=20).endswith("\n10 more rows are not shown.") and "<p>10 more rows are not shown.</p>" in export.html_page("t", many, most=20)
    assert "more rows" not in export.markdown_table(many, most=30) + export.html_page("t", many, most=30)
    page = export.html_page("T & t", df)
    assert "<h1>T &amp; t</h1>" in page and "<td>b|&lt;</td><td></td>" in page and page.count("<tr>") == 3
    export.write_document(df, str(tmp_path / "x" / "a.json"))
    assert json.loads((tmp_path / "x" / "a.json").read_text()) == [{"k": "a", "n": 1}, {"k": "b|<"}]
    export.write_document(df, str(tmp_path / "m.json"), "map", "k")
    assert json.loads((tmp_path / "m.json").read_text()) == {"a": {"n": 1}, "b|<": {}}
    with pytest.raises(ValueError, match="write_lines"):
        export.write_document(df, str(tmp_path / "n.json"), most=1)
    export.write_lines(df, f"file://{tmp_path}/lines")
    assert sorted(r[0] for r in spark.read.text(f"file://{tmp_path}/lines").collect()) == ['{"k":"a","n":1}', '{"k":"b|<"}']
    stats = spark.createDataFrame([(3, 2)], "totalComments int, totalThemes int")
    document = spark.createDataFrame([("D", "K", "T")], "document_id string, docket_id string, title string")
    row = export.meta(document, stats, F.to_timestamp(F.lit("2024-01-02 03:04:05"))).first()
    assert (row.documentId, row.sourceDocumentId, row.generatedAt, row.stats.totalThemes) == ("K", "D", "2024-01-02T03:04:05Z", 2)


def test_backfill_and_cache(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("b", 0), ("c", 7), ("d", None)], "comment_id string, word_count int")
    texts = spark.createDataFrame([("a", "x y"), ("b", "x"), ("c", "x")], "comment_id string, markdown string")
    filled = collection.fill_word_counts(rows, texts, "comment_id", F.size(F.split("markdown", " ")))
    assert {r.comment_id: r.word_count for r in filled.collect()} == {"a": 2, "b": 1, "c": 7, "d": None}
    cache = spark.createDataFrame([("1", "x"), ("2", ""), ("3", None)], "prompt_hash string, result string")
    assert {r.prompt_hash for r in verify_cache(cache).collect()} == {"2", "3"}
    store = Store(spark, f"file://{tmp_path}/s")
    store.overwrite("comment_entities", cache)
    store.overwrite("comments", cache)
    store.overwrite("llm_cache", cache)
    assert store.clear_derived() == {"comment_entities": 3} and store.exists("comments") and store.exists("llm_cache")
    assert store.clear_derived(cache=True) == {"llm_cache": 3} and not store.exists("llm_cache") and store.columns("llm_cache") == []
    done = spark.createDataFrame([("a", "completed"), ("b", "completed"), ("c", "failed")], "comment_id string, status string").withColumn("structured_sections", F.struct(F.lit("p").alias("corePosition"), F.lit("").alias("keyRecommendations"), F.lit("c").alias("mainConcerns")))
    comments, ids = rows.select(F.col("comment_id").alias("id")), spark.createDataFrame([("a",), ("c",)], "id string")
    none = texts.limit(0).withColumn("status", F.lit("completed"))
    assert [tuple(r) for r in collection.condensed_content(comments, done, none, ids).select("id", "content").collect()] == [("a", "p\n\nc")]


def test_shared_tables(spark):
    with shared.tables_made() as made:
        table = shared.materialize(spark.range(3).toDF("x"), "t")
        with shared.tables_made() as inner:
            other = shared.materialize(table, "u")
    assert len(made) == len(inner) == 1 and made != inner and other.count() == 3
    shared.discard(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(*made).count()
    assert shared.small(spark.range(3), 3).count() == 3
    shared.delete(spark, *inner)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://x:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared.shared_dir(Cluster())
