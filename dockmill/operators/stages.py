"""Generation stages over documents: transcribe, condense, themes, extracts, summaries, entities.

Each stage takes DataFrames and a model name and returns DataFrames; results are
cached by prompt (see :mod:`dockmill.operators.generate`), so a stage that is
run again asks only for what is new.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.functions import text as t
from dockmill.functions.parsers import parse_entities, parse_themes
from dockmill.operators.batching import even_batches, merge_groups
from dockmill.operators.collection import themes_with_at_least, transcription_source
from dockmill.operators.enrich import extract_block, prompt_lines, sections_block
from dockmill.operators.entities import annotate, frequency_band, with_definitions
from dockmill.operators.generate import PARTS, generate, generate_multimodal, repair_ids, suffix_ids
from dockmill.plans.shared import materialize

# The sections that a block of a prompt shows, with their tags.
SECTION_TAGS = {
    "commenterProfile": "commenter_profile",
    "corePosition": "core_position",
    "keyRecommendations": "key_recommendations",
    "mainConcerns": "main_concerns",
    "notableExperiences": "notable_experiences",
    "keyQuotations": "key_quotations",
}
EXTRACT = "struct<relevance:int,extract:map<string,array<string>>>"


def transcribe(comments: DataFrame, model: str, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(``id``, ``markdown``, ``word_count``, ``status``) of comments (``id``, ``content``)."""
    asked, fresh = generate(comments.withColumn("prompt", F.concat(F.lit("Transcribe to Markdown:\n"), "content")), "prompt", model, cache, task_type="transcribe", post=_markdown)
    return _transcribed(asked), fresh


def transcribe_files(comments: DataFrame, attachments: DataFrame, model: str, native: list[str], cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`transcribe` of comments with their files: of each attachment the format that the model reads best, as typed parts."""
    chosen = transcription_source(attachments, native)
    part = F.struct(F.concat(F.lit("application/"), F.col("format")).alias("mime"), F.lit(None).cast("string").alias("text"), F.col("blob_data").alias("data"))
    files = chosen.groupBy("comment_id").agg(F.array_sort(F.collect_list(F.struct("ord", "id", part.alias("p")))).alias("files"))
    rows = comments.select("id", "content").join(files, F.col("id") == F.col("comment_id"), "left")
    own = F.array(F.struct(F.lit("text/plain").alias("mime"), F.concat(F.lit("Transcribe to Markdown:\n"), "content").alias("text"), F.lit(None).cast("binary").alias("data")))
    parts = F.concat(own, F.coalesce(F.transform("files", lambda x: x.p), F.slice(own, 1, 0)))
    asked, fresh = generate_multimodal(rows.select("id", parts.cast(PARTS).alias("parts")), "parts", model, cache, task_type="transcribe", post=_markdown)
    return _transcribed(asked), fresh


def _markdown(result: Column) -> Column:
    return t.given(t.trim_space(result))


def _transcribed(asked: DataFrame) -> DataFrame:
    return asked.select("id", F.col("parsed").alias("markdown"), t.split_count(F.col("parsed")).alias("word_count"), F.when(F.col("parsed").isNull(), "failed").otherwise("completed").alias("status"))


def condense(transcribed: DataFrame, model: str, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(``id``, ``structured_sections``, ``errors``, ``status``) of (``id``, ``markdown``) and, for lines about the submitter, ``attributes_json``."""
    who = prompt_lines(F.col("attributes_json")) if "attributes_json" in transcribed.columns else F.lit("No submitter metadata available")
    prompt = F.concat(F.lit("Condense into sections.\nSubmitter:\n"), who, F.lit("\n\nComment:\n"), "markdown")
    asked, fresh = generate(transcribed.withColumn("prompt", prompt), "prompt", model, cache, task_type="condense")
    found = asked.withColumn("structured_sections", t.sections(F.col("result"))).withColumn("errors", t.section_errors(F.col("result")))
    return found.select("id", "structured_sections", "errors", F.when(F.size("structured_sections") > 0, "completed").otherwise("failed").alias("status")), fresh


def discover_themes(comments: DataFrame, model: str, *, batch_words: int = 150_000, width: int = 10, cache: DataFrame | None = None) -> list:
    """Theme outline of comments (``id``, ``content``, ``word_count``) by batches and a merge tree."""
    dealt = even_batches(comments.select(F.lit(0).alias("g"), "id", F.col("word_count").alias("w")), "g", "id", "w", batch_words)
    block = F.concat(F.lit('<comment id="'), "id", F.lit('">\n'), "content", F.lit("\n</comment>"))
    parts = comments.join(dealt.select("id", "batch"), "id").groupBy("batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", block.alias("b")))), lambda x: x.b), "\n").alias("text"))
    level = parts.select(F.col("batch").alias("nr"), "text")
    while True:
        asked, _ = generate(level.withColumn("prompt", F.concat(F.lit("Outline the themes:\n"), "text")), "prompt", model, cache, task_type="themes")
        n = asked.count()  # batches of one collection
        if n <= 1:
            rows = asked.select("result").collect()
            return parse_themes(rows[0][0]) if rows else []
        group = merge_groups(F.lit(n), F.col("nr"), width)
        level = asked.groupBy(group.alias("nr")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nr", "result"))), lambda x: x.result), "\n\n").alias("text"))


def theme_groups(themes: DataFrame) -> DataFrame:
    """(``top``, ``text``): the themes below each top code, a line each."""
    line = F.concat("code", F.lit(": "), "description", F.lit(". "), F.coalesce("detailed_guidelines", F.lit("")))
    rows = themes.select(F.split("code", r"\.")[0].cast("int").alias("top"), F.struct(t.natural_key(F.col("code")).alias("k"), line.alias("line")).alias("x"))
    return rows.groupBy("top").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x.line), "\n").alias("text")).orderBy("top")


def extract_content(comments: DataFrame, themes: DataFrame, model: str, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows (``comment_id``, ``theme_code``, ``extract``), processed ids, new cache rows).

    Every comment meets every group of themes: the groups are the stated set, one
    per top-level theme.  All of a comment's prompts stand together.
    """
    asked = comments.select(F.col("id").alias("comment_id"), "content").crossJoin(theme_groups(themes))
    asked = asked.withColumn("prompt", F.concat(F.lit("Themes:\n"), "text", F.lit("\nComment:\n"), "content")).repartition("comment_id").sortWithinPartitions("comment_id", "top")
    answers, fresh = generate(asked, "prompt", model, cache, task_type="extract")
    parsed = answers.select("comment_id", "top", F.from_json(t.json_body(F.col("result")), f"map<string,{EXTRACT}>").alias("m"))
    rows = parsed.select("comment_id", "top", F.explode("m").alias("theme_code", "x")).where("x.relevance = 1")
    rows = rows.groupBy("comment_id", "theme_code").agg(F.max_by("x", "top").alias("x"))  # of groups that name a theme the last counts
    cleaned = rows.select("comment_id", "theme_code", t.clean_extract(F.col("x.extract")).alias("extract")).where("extract is not null")
    return cleaned, answers.select("comment_id").distinct(), fresh


def removed_items(before: Column, after: Column) -> Column:
    """Items that cleaning took out of a map of lists."""
    n = lambda m: F.aggregate(F.map_values(m), F.lit(0), lambda a, x: a + F.size(x))
    return n(before) - F.coalesce(n(after), F.lit(0))


def extract_words(extract: Column, profile: Column | None = None) -> Column:
    """Words of an extract's items and of the commenter's profile."""
    text = F.array_join(F.flatten(F.map_values(extract)), " ")
    return t.word_count(text if profile is None else F.concat_ws(" ", text, profile))


def represented(sizes: DataFrame, by: str) -> DataFrame:
    """Submissions and perspectives by theme, with a note where they differ."""
    per = sizes.groupBy(by).agg(F.sum("cluster_size").alias("submissions"), F.count("*").alias("perspectives"))
    return per.withColumn("note", F.when(F.col("submissions") != F.col("perspectives"), F.format_string("%d submissions with %d distinct texts", "submissions", "perspectives")))


def summarize(extracts: DataFrame, model: str, known: DataFrame, *, batch_words: int = 40_000, least: int = 1, cache: DataFrame | None = None) -> DataFrame:
    """(``theme_code``, ``summary``, ``sections``, ``comment_count``) of the themes with ``least`` comments or more.

    ``extracts``: (``theme_code``, ``comment_id``, ``extract``, ``cluster_size``), and
    ``structured_sections`` if the commenter's profile is to count as words too.  A
    theme's extracts are summarised in even batches and the parts merged.
    ``sections`` is the JSON of the answer with comment ids that were cut short
    completed from ``known`` (``id``); NULL where the answer has no valid JSON.
    """
    kept = extracts.join(themes_with_at_least(extracts, least).select("theme_code"), "theme_code", "left_semi")
    profile = F.col("structured_sections")["commenterProfile"] if "structured_sections" in extracts.columns else None
    block = extract_block(F.col("comment_id"), F.col("extract"), F.lit(1), F.lit(None).cast("string"), F.col("cluster_size"))
    texts = kept.select("theme_code", F.col("comment_id").cast("string").alias("comment_id"), "cluster_size", block.alias("line"), extract_words(F.col("extract"), profile).cast("long").alias("w"))
    dealt = even_batches(texts, "theme_code", "comment_id", "w", batch_words)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("cluster_size")).alias("n"), "comment_id", "line")))
    parts = texts.join(dealt, ["theme_code", "comment_id"]).groupBy("theme_code", "batch").agg(F.array_join(F.transform(ordered, lambda x: x.line), "\n\n---\n\n").alias("text"), F.sum("cluster_size").alias("n"))
    first, _ = generate(parts.withColumn("prompt", F.concat(F.lit("Summarize:\n"), "text")), "prompt", model, cache, task_type="summarize")
    joined = first.groupBy("theme_code").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("batch", "result"))), lambda x: x.result), "\n").alias("text"), F.sum("n").alias("comment_count"))
    last, _ = generate(joined.withColumn("prompt", F.concat(F.lit("Merge summaries:\n"), "text")), "prompt", model, cache, task_type="summarize-merge")
    answers = last.select("theme_code", F.col("result").alias("summary"), t.valid_json(F.col("result")).alias("json"), "comment_count")
    return answers.join(_repaired(answers, known), "theme_code", "left").select("theme_code", "summary", "sections", "comment_count")


def _repaired(answers: DataFrame, known: DataFrame) -> DataFrame:
    """(``theme_code``, ``sections``): JSON answers with their comment ids completed.

    Only the ids that answers mention are looked up among the known ones, so
    what a task holds is one answer's ids.
    """
    asked = answers.where("json is not null").select("theme_code", "json")
    mentioned = asked.select("theme_code", F.explode(F.array_distinct(F.regexp_extract_all("json", F.lit(r'"([^"\\]+)"')))).alias("said"))
    names = known.select("id").distinct().select("id", F.col("id").alias("said")).unionByName(suffix_ids(known).select("id", F.col("suffix").alias("said")))
    found = mentioned.withColumn("said", F.ltrim(F.col("said"), F.lit("-"))).distinct().join(names, "said")
    per = found.groupBy("theme_code").agg(F.collect_set(F.struct("said", "id")).alias("names"))

    def run(batches):
        for df in batches:
            out = []
            for text, pairs in zip(df["json"], df["names"], strict=True):
                unique = {p["said"]: p["id"] for p in ([] if pairs is None else pairs)}
                out.append(json.dumps(repair_ids(json.loads(text), set(unique.values()), unique), ensure_ascii=False))
            yield pd.DataFrame({"theme_code": df["theme_code"], "sections": out})

    return asked.join(per, "theme_code", "left").mapInPandas(run, "theme_code string, sections string")


def summarize_sections(rows: DataFrame, model: str, *, batch_words: int = 125_000, width: int = 4, cache: DataFrame | None = None) -> DataFrame:
    """(``theme_code``, ``summary``, ``comment_count``) from condensed sections: batches by words, then a merge tree.

    ``rows``: (``theme_code``, ``comment_id``, ``structured_sections``), such as of
    :func:`dockmill.operators.explore.scored_comments`.
    """
    block = sections_block(F.col("comment_id").cast("string"), F.col("structured_sections"), SECTION_TAGS)
    texts = rows.select("theme_code", F.col("comment_id").cast("string").alias("comment_id"), block.alias("line"))
    texts = texts.withColumn("w", t.split_count(F.col("line")).cast("long"))
    dealt = even_batches(texts, "theme_code", "comment_id", "w", batch_words)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("comment_id", "line"))), lambda x: x.line)
    level = texts.join(dealt, ["theme_code", "comment_id"]).groupBy("theme_code", F.col("batch").alias("nr")).agg(F.array_join(ordered, "\n\n").alias("text"), F.count("*").alias("n"))
    done = None
    while True:
        asked, _ = generate(level.withColumn("prompt", F.concat(F.lit("Summarize:\n"), "text")), "prompt", model, cache, task_type="summarize-sections")
        sizes = asked.groupBy("theme_code").agg(F.count("*").alias("parts"))
        asked = materialize(asked.join(sizes, "theme_code").select("theme_code", "nr", "result", "n", "parts"), "summaries")
        single = asked.where("parts = 1").select("theme_code", F.col("result").alias("summary"), F.col("n").alias("comment_count"))
        done = single if done is None else done.unionByName(single)
        rest = asked.where("parts > 1")
        if rest.isEmpty():
            return done
        place = F.row_number().over(Window.partitionBy("theme_code").orderBy("nr")) - 1
        group = rest.withColumn("i", place).withColumn("group", merge_groups(F.col("parts"), F.col("i"), width))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("nr", "result"))), lambda x: x.result)
        level = group.groupBy("theme_code", F.col("group").alias("nr")).agg(F.array_join(ordered, "\n\n").alias("text"), F.sum("n").alias("n"))


def discover_entities(sample: DataFrame, comments: DataFrame, model: str, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(taxonomy, mentions): a dictionary from a sample's texts, matched in all comments and kept within the frequency band."""
    spark = sample.sparkSession
    text = sample.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "content"))), lambda x: x.content), "\n\n").alias("text"))  # bounded by the sample's word budget
    asked, _ = generate(text.withColumn("prompt", F.concat(F.lit("List the entities:\n"), "text")), "prompt", model, cache, task_type="entities")
    found = parse_entities(asked.select("result").first()[0] or "")
    rows = [(c, e.label, e.definition, e.terms) for c, es in found.items() for e in es]
    taxonomy = with_definitions(spark.createDataFrame(rows, "category string, label string, definition string, terms array<string>"))
    mentions = annotate(comments, "id", "content", taxonomy)
    band = frequency_band(mentions, "id", comments.agg(F.count("*").alias("n")))
    return taxonomy.join(band.select("category", "label"), ["category", "label"], "left_semi"), mentions.join(band.select("category", "label"), ["category", "label"], "left_semi")


def usage(rows: DataFrame, per_million: tuple[float, float, float]) -> DataFrame:
    """Token totals, cost and the share served from cache of (``prompt_tokens``, ``cached_tokens``, ``output_tokens``)."""
    plain, cached, out = per_million
    sums = rows.agg(*(F.sum(c).alias(c) for c in ("prompt_tokens", "cached_tokens", "output_tokens")))
    cost = ((F.col("prompt_tokens") - F.col("cached_tokens")) * plain + F.col("cached_tokens") * cached + F.col("output_tokens") * out) / 1e6
    return sums.withColumn("cost", cost).withColumn("cache_pct", F.round(100 * F.col("cached_tokens") / F.col("prompt_tokens"), 1))


__all__ = ["condense", "discover_entities", "discover_themes", "extract_content", "extract_words", "removed_items", "represented", "suffix_ids", "summarize", "summarize_sections", "theme_groups", "transcribe", "transcribe_files", "usage"]
