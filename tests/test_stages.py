"""Generation stages with providers that answer what the stage needs."""

import json

from pyspark.sql import functions as F

from dockmill.operators import stages
from dockmill.operators.generate import PROVIDERS


def test_extracts_are_strict_and_cleaned(spark):
    def answer(prompt):
        top = "1" if "1: A" in prompt else "2"
        out = {f"{top}.1": {"relevance": 1, "extract": {"positions": [f"said in {top}", "No comment"], "concerns": ["Not addressed"], "other": ["x"]}}}
        out["1.9"] = {"relevance": 1, "extract": {"positions": [f"from {top}"]}}
        out[f"{top}.2"] = {"relevance": 2, "extract": {"positions": ["loosely"]}}
        return f"Sure:\n```json\n{json.dumps(out)}\n```"

    PROVIDERS["extracts"] = answer
    comments = spark.createDataFrame([("a", "text a"), ("b", "text b")], "id string, content string")
    themes = spark.createDataFrame([("1", "A", None), ("1.1", "B", "g"), ("2", "D", None)], "code string, description string, detailed_guidelines string")
    rows, processed, fresh = stages.extract_content(comments, themes, "extracts")
    got = {(r.comment_id, r.theme_code): r.extract for r in rows.collect()}
    want = {(c, f"{k}.1"): {"positions": [f"said in {k}"]} for c in "ab" for k in "12"} | {(c, "1.9"): {"positions": ["from 2"]} for c in "ab"}
    assert got == want and processed.count() == 2 and fresh.count() == 4
    again, _, none = stages.extract_content(comments, themes, "extracts", fresh)
    assert again.count() == 6 and none.count() == 0


def test_themes_are_merged_to_one_outline(spark):
    calls = []

    def outline(prompt):
        return f"1. Costs. About costs.\n1.1. Fees. {prompt.count('<comment')} here."

    PROVIDERS["themes"] = outline
    comments = spark.createDataFrame([(f"c{i}", f"text {i}", 10) for i in range(9)], "id string, content string, word_count int")
    themes = stages.discover_themes(comments, "themes", batch_words=20, width=2)
    assert [(t.code, t.description, t.parent_code) for t in themes] == [("1", "Costs", None), ("1.1", "Fees", "1")] and calls == []


def test_entities_are_found_and_banded(spark):
    PROVIDERS["entities"] = lambda prompt: '1. Agencies\n* CMS: The agency\n * "CMS"\n * Centers\n* Rare: Never seen\n * zzz\n* All: Everywhere\n * text'
    comments = spark.createDataFrame([(f"c{i}", f"text {'CMS' if i % 4 == 0 else 'xCMSx'}") for i in range(20)], "id string, content string")
    taxonomy, mentions = stages.discover_entities(comments.limit(5), comments, "entities")
    assert [(r.label, r.definition, r.terms) for r in taxonomy.collect()] == [("CMS", "The agency", ["CMS", "Centers"])]
    assert {(r.id, r.label) for r in mentions.collect()} == {(f"c{i}", "CMS") for i in range(0, 20, 4)}


def test_condense_reads_who_submits(spark):
    seen = "### CORE POSITION\nAgainst.\n### MAIN CONCERNS\nCost."
    PROVIDERS["sections"] = lambda prompt: seen if "Organization: Org" in prompt else "nothing"
    rows = spark.createDataFrame([("a", "m", '{"organization":"Org"}'), ("b", "m", "{}")], "id string, markdown string, attributes_json string")
    got = {r.id: (r.status, r.structured_sections) for r in stages.condense(rows, "sections")[0].collect()}
    assert got == {"a": ("completed", {"corePosition": "Against.", "mainConcerns": "Cost."}), "b": ("failed", {})}


def test_blocks_of_prompts(spark):
    from dockmill.operators.enrich import bullet_lists, said

    m = F.create_map(F.lit("keyQuotations"), F.lit("No standout quotations"), F.lit("corePosition"), F.lit("No specific concerns raised"))
    row = spark.range(1).select(said(m, "keyQuotations").alias("q"), said(m, "corePosition").alias("p"), said(m, "mainConcerns").alias("c"), bullet_lists(F.create_map(F.lit("b"), F.array(F.lit("x"), F.lit("y"))), {"a": "A", "b": "B"}).alias("l")).first()
    assert (row.q, row.p, row.c, row.l) == (None, "No specific concerns raised", None, "**B:**\n- x\n- y")
