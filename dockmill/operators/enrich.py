"""What a submission says together with who says it: metadata, prompt lines, enriched texts.

All are Column builders over the JSON of attributes or one-to-one joins; blank
values count as missing throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmill.functions.text import first_given, given, trim_space, word_count

# What generated sections say when there is nothing to say.
EMPTY_SECTIONS = {
    "keyRecommendations": ["No specific recommendations provided"],
    "mainConcerns": ["No specific concerns raised"],
    "notableExperiences": ["No distinctive experiences shared"],
    "keyQuotations": ["No standout quotations", "No key quotations provided"],
}

# Markers of an enriched text.
METADATA_MARK, TEXT_MARK, ATTACHMENTS_MARK = "=== COMMENT METADATA ===", "=== COMMENT TEXT ===", "=== ATTACHMENTS ==="


def attribute(attrs: Column, name: str) -> Column:
    """A text of a JSON object; NULL where it is missing or empty."""
    return given(F.get_json_object(attrs, f"$.{name}"))


# The attributes that metadata come from, and those that hold the text.
ATTRIBUTES, TEXTS = ("organization", "firstName", "lastName", "category", "city", "stateProvinceRegion", "country", "postedDate", "receiveDate"), ("comment", "text")


def metadata(attrs: Column) -> Column:
    """(``submitter``, ``submitter_type``, ``organization``, ``location``, ``date``) of a JSON object of attributes."""
    return _metadata(lambda name: attribute(attrs, name))


def _metadata(at) -> Column:
    organization, country = at("organization"), at("country")
    name = given(F.concat_ws(" ", at("firstName"), at("lastName")))
    kind = F.coalesce(at("category"), F.when(organization.isNotNull(), "Organization").otherwise("Individual"))
    place = given(F.concat_ws(", ", at("city"), at("stateProvinceRegion"), F.when(country != "United States", country)))
    return F.struct(
        F.coalesce(organization, name, F.lit("Anonymous")).alias("submitter"),
        kind.alias("submitter_type"),
        organization.alias("organization"),
        place.alias("location"),
        F.coalesce(at("postedDate"), at("receiveDate")).alias("date"),
    )


def labelled(label: str, x: Column) -> Column:
    """``label: x``; NULL where there is no value, so that it leaves no line."""
    return F.concat(F.lit(f"{label}: "), given(x))


def prompt_lines(attrs: Column) -> Column:
    """The submitter's name, organization and category, a line each, for a prompt."""
    name = F.concat_ws(" ", attribute(attrs, "firstName"), attribute(attrs, "lastName"))
    lines = F.concat_ws("\n", labelled("Submitter Name", name), labelled("Organization", attribute(attrs, "organization")), labelled("Category", attribute(attrs, "category")))
    return first_given(lines, F.lit("No submitter metadata available"))


def joined_attachments(attachments: DataFrame, key: str = "comment_id") -> DataFrame:
    """(``key``, ``block``): the texts of each comment's attachments, in order, each under a header.

    ``attachments``: (``key``, ``ord``, ``format``, ``file_name``, ``text``).  A text
    in parentheses is a remark about the file and stands in its header's line.
    """
    text = F.coalesce(trim_space(F.col("text")), F.lit(""))
    head = F.concat(F.lit("\n"), F.upper("format"), F.lit(": "), F.col("file_name"))
    plain = (text != "") & ~F.startswith(text, F.lit("("))
    part = F.when(plain, F.concat(head, F.lit("\n"), text)).otherwise(F.concat(head, F.lit(" "), first_given(text, F.lit("(no extractable text)"))))
    parts = attachments.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", part.alias("part")))).alias("parts"))
    return parts.select(key, F.array_join(F.transform("parts", lambda x: x.part), "\n").alias("block"))


def enriched(comments: DataFrame, attachments: DataFrame | None = None) -> DataFrame:
    """(``id``, ``content``, ``word_count``, ``metadata``) of comments (``id``, ``attributes_json``) that have a text.

    ``attachments``: of :func:`joined_attachments`' input.
    """
    attrs = F.col("attributes_json")
    # One pass over the JSON, whose longest part is the text itself; as a generator it isn't repeated for the filter.
    names = [*ATTRIBUTES, *TEXTS]
    parsed = comments.select("id", F.json_tuple(attrs, *names).alias(*(f"__{n}" for n in names)))
    rows = parsed.select("id", _metadata(lambda name: given(f"__{name}")).alias("metadata"), first_given(*(f"__{n}" for n in TEXTS)).alias("text"))
    rows = rows.where(trim_space(F.col("text")) != "")
    m = F.col("metadata")
    lines = [
        F.lit(METADATA_MARK),
        labelled("ID", F.col("id")),
        labelled("Date", F.coalesce(m.date, F.lit("Unknown"))),
        labelled("Submitter", m.submitter),
        labelled("Type", m.submitter_type),
        labelled("Organization", m.organization),
        labelled("Location", m.location),
        F.lit(f"\n{TEXT_MARK}"),
        F.col("text"),
    ]
    if attachments is not None:
        blocks = joined_attachments(attachments).select(F.col("comment_id").alias("__c"), "block")
        rows = rows.join(blocks, F.col("id") == F.col("__c"), "left").drop("__c")
        lines.append(F.concat(F.lit(f"\n{ATTACHMENTS_MARK}\n"), F.col("block")))
    content = rows.select("id", F.concat_ws("\n", *lines).alias("content"), "metadata")
    return content.select("id", "content", word_count(F.col("content")).alias("word_count"), "metadata")


def clustering_text(content: Column) -> Column:
    """What stands between the first text marker and the next; the whole content without one."""
    parts = F.split(content, TEXT_MARK)
    return trim_space(F.coalesce(F.get(parts, F.lit(1)), content))


def condensed_for_entities(comments: DataFrame, condensed: DataFrame, transcriptions: DataFrame) -> DataFrame:
    """(``id``, ``content``, ``word_count``, ``metadata``, ``structured_sections``) of completed condensed comments: lines about the submitter, then the transcription."""
    done = condensed.where("status = 'completed'").select(F.col("comment_id").alias("__c"), "structured_sections")
    texts = transcriptions.where("status = 'completed'").select(F.col("comment_id").alias("__t"), "markdown")
    rows = comments.select("id", metadata(F.col("attributes_json")).alias("metadata")).join(done, F.col("id") == F.col("__c")).join(texts, F.col("id") == F.col("__t"), "left")
    m = F.col("metadata")
    who = F.concat(F.lit("["), m.submitter_type, F.lit("] "), m.submitter)
    content = F.concat_ws("\n", who, labelled("Organization", m.organization), labelled("Location", m.location), F.lit(""), given("markdown"))
    return rows.select("id", content.alias("content"), "metadata", "structured_sections").withColumn("word_count", word_count(F.col("content")))


def said(sections: Column, name: str) -> Column:
    """A section's text; NULL where it is missing or says that there is nothing."""
    x = given(F.element_at(sections, F.lit(name)))
    empty = EMPTY_SECTIONS.get(name)
    return x if not empty else F.when(~x.isin(empty), x)


def tagged(tag: str, x: Column) -> Column:
    """``x`` between lines with the tag; NULL without ``x``."""
    return F.concat(F.lit(f"<{tag}>\n"), x, F.lit(f"\n</{tag}>"))


def sections_block(comment_id: Column, sections: Column, names: dict[str, str]) -> Column:
    """A comment's sections as a block for a prompt; ``names``: tag by section, in order."""
    return F.concat_ws("\n", F.concat(F.lit('<comment id="'), comment_id, F.lit('">')), *(tagged(tag, said(sections, name)) for name, tag in names.items()), F.lit("</comment>"))


# Headings of an extract's lists.
EXTRACT_HEADINGS = {"positions": "Positions", "concerns": "Concerns", "recommendations": "Recommendations", "experiences": "Experiences/Examples", "key_quotes": "Key Quotes"}


def bullet_lists(lists: Column, headings: dict[str, str]) -> Column:
    """A map of lists as Markdown, in the order of ``headings``; empty lists leave nothing."""

    def block(name: str, title: str) -> Column:
        items = F.element_at(lists, F.lit(name))
        return F.when(F.size(items) > 0, F.concat(F.lit(f"**{title}:**\n"), F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")))

    return F.concat_ws("\n\n", *(block(*h) for h in headings.items()))


def extract_block(comment_id: Column, extract: Column, relevance: Column, profile: Column, cluster_size: Column) -> Column:
    """One comment's extract for a theme's summary, with how many submissions it stands for."""
    size = cluster_size.cast("string")
    label = (
        F.when(cluster_size >= 100, F.concat(F.lit("[FORM LETTER - "), size, F.lit(" identical submissions]")))
        .when(cluster_size >= 10, F.concat(F.lit("[CLUSTER - "), size, F.lit(" similar submissions]")))
        .when(cluster_size > 1, F.concat(F.lit("[SMALL CLUSTER - "), size, F.lit(" similar comments]")))
        .otherwise("[INDIVIDUAL]")
    )
    body = first_given(bullet_lists(extract, EXTRACT_HEADINGS), F.lit("No specific content extracted for this theme"))
    content = F.concat(F.lit('<theme_specific_content relevance="'), relevance.cast("string"), F.lit('">\n'), body, F.lit("\n</theme_specific_content>"))
    who = F.concat(F.lit("<commenter_profile>\n"), F.coalesce(given(profile), F.lit("No profile information provided")), F.lit("\n</commenter_profile>"))
    return F.concat(F.lit('<comment id="'), comment_id.cast("string"), F.lit('">\n'), label, F.lit("\n"), who, F.lit("\n\n"), content, F.lit("\n</comment>"))
