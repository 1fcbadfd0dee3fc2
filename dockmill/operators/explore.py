"""The interactive surface: search, facets, rankings, rollups and pages."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockmill.functions.text import first_given, given, natural_key
from dockmill.operators.enrich import bullet_lists, said
from dockmill.plans.ordering import numbered


@dataclass(frozen=True)
class Token:
    """A term or phrase of a query; tokens of one group are alternatives."""

    kind: str
    value: str
    negated: bool
    group: int


# One token: OR between blanks, or an optional minus and a closed phrase, an open one, or a run without blanks and quotes.
_TOKEN = re.compile(r"""(?P<or>(?i:or))(?=\ |\Z)|(?P<minus>-)?+(?:"(?P<phrase>[^"]*)"|"(?P<open>[^"]*)\Z|(?P<term>[^"\ ]+))""")


def parse_search(query: str, or_mode: str = "documented") -> list[Token]:
    """Terms, "phrases" (an open one takes the rest), ``-`` for negation, OR between alternatives.

    ``or_mode="parity"`` puts every token into a group of its own, so that OR
    reads as AND.  A leading OR is a plain term.
    """
    out: list[Token] = []
    joined = False
    for m in _TOKEN.finditer(query):
        if m["or"] and out:
            joined = True
        elif value := m["phrase"] or m["open"] or m["or"] or m["term"]:
            alternative = joined and or_mode == "documented"
            group = out[-1].group + (not alternative) if out else 0
            out.append(Token("term" if m["term"] or m["or"] else "phrase", value, bool(m["minus"]), group))
            joined = False
    return out


def search_string(tokens: list[Token]) -> str:
    """A query that parses to the tokens."""
    out, last = [], None
    for t in tokens:
        if t.group == last:
            out.append("OR")
        out.append(("-" if t.negated else "") + (f'"{t.value}"' if t.kind == "phrase" else t.value))
        last = t.group
    return " ".join(out)


def without(tokens: list[Token], at: int) -> list[Token]:
    """The tokens but one, groups numbered from 0 again."""
    left = tokens[:at] + tokens[at + 1 :]
    number = {g: i for i, g in enumerate(dict.fromkeys(t.group for t in left))}
    return [Token(t.kind, t.value, t.negated, number[t.group]) for t in left]


PREFIXES = ("theme:", "entity:", "type:")


def prefix_of(query: str) -> tuple[str | None, str, str]:
    """(picker, text after the colon, query before the prefix) of a query being typed."""
    at, found = max(((query.lower().rfind(p), p) for p in PREFIXES), default=(-1, ""))
    if at < 0 or (at > 0 and query[at - 1] != " "):
        return None, "", query
    return found[:-1], query[at + len(found) :], query[:at].strip()


def search_text(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(given(p) for p in parts)))


def matches(text: Column, tokens: list[Token]) -> Column:
    """Every group must match: none of its negated tokens occurs, and one of the others does."""
    out = F.lit(True)
    for g in dict.fromkeys(t.group for t in tokens):
        members = [t for t in tokens if t.group == g]
        has = {t: F.contains(text, F.lit(t.value.lower())) for t in members}
        for t in members:
            if t.negated:
                out = out & ~has[t]
        if positive := [has[t] for t in members if not t.negated]:
            out = out & reduce(lambda a, b: a | b, positive)
    return out


def representatives_only(comments: DataFrame) -> DataFrame:
    """Representatives, or all comments if none is marked as one."""
    any_ = comments.agg(F.coalesce(F.bool_or(F.coalesce("is_representative", F.lit(False))), F.lit(False)).alias("__any"))
    return comments.crossJoin(any_).where("is_representative or not __any").drop("__any")  # one row on the right


def facets(comments: DataFrame, *, themes: list[str] = (), entities: list[tuple[str, str]] = (), types: list[str] = (), tokens: list[Token] = (), text: str = "search_text", max_score: int = 2) -> DataFrame:
    """Facets combine with AND, values inside one with OR."""
    out = comments
    if tokens:
        out = out.where(matches(F.col(text), list(tokens)))
    if themes:
        scores = F.col("theme_scores")
        out = out.where(reduce(lambda a, b: a | b, [F.coalesce(F.element_at(scores, F.lit(t)).between(1, max_score), F.lit(False)) for t in themes]))
    if entities:
        wanted = F.array(*(F.struct(F.lit(c).alias("category"), F.lit(x).alias("label")) for c, x in entities))
        out = out.where(F.arrays_overlap("entities", wanted))
    if types:
        out = out.where(F.col("submitter_type").isin(list(types)))
    return out


def percentile(rows: DataFrame, value: str, out: str = "percentile") -> DataFrame:
    """Share of smaller values in percent, rounded; 100 for a single row.

    Distinct values are ranked, so the one ordered task sees a row per value.
    """
    counts = rows.groupBy(value).agg(F.count("*").alias("__c"))
    w = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("__less", F.coalesce(F.sum("__c").over(w), F.lit(0)))
    ranked = ranked.crossJoin(counts.agg(F.sum("__c").alias("__n")))  # one row on the right
    share = F.when(F.col("__n") == 1, 100).otherwise(F.floor(F.col("__less") / (F.col("__n") - 1) * 100 + 0.5)).cast("int")
    return rows.join(ranked.select(F.col(value).alias("__v"), share.alias(out)), F.col(value).eqNullSafe(F.col("__v"))).drop("__v")


def top_types(comments: DataFrame, least: int = 5, k: int = 5) -> DataFrame:
    """The ``k`` submitter types with ``least`` comments or more."""
    per = comments.groupBy("submitter_type").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return per.orderBy(F.desc("n"), "submitter_type").limit(k)


def distinct_values(rows: DataFrame, column: str, least: int = 1) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(column)


def theme_distribution(mentions: DataFrame, extracts: DataFrame, entity: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` themes of the comments that mention an entity (one row: ``category``, ``entity_label``)."""
    ids = mentions.join(entity, ["category", "entity_label"], "left_semi").select("comment_id").distinct()
    return extracts.select("comment_id", "theme_code").distinct().join(ids, "comment_id", "left_semi").groupBy("theme_code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "theme_code").limit(k)


def share(rows: DataFrame, condition: Column, out: str) -> DataFrame:
    """Rounded percentage of rows under a condition."""
    return rows.agg(F.floor(100 * F.avg(F.when(condition, 1.0).otherwise(0.0)) + 0.5).cast("int").alias(out))


def page(rows: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` from 0."""
    return rows.orderBy(*order).offset(number * size).limit(size)


def page_count(rows: DataFrame, size: int) -> DataFrame:
    return rows.agg(F.ceil(F.count("*") / size).cast("long").alias("pages"))


def by_list_size(summaries: DataFrame, array: str, tie: str) -> DataFrame:
    """Longest list first; a missing one counts as empty."""
    return summaries.orderBy(F.coalesce(F.size(array), F.lit(0)).desc(), tie)


def picker(items: DataFrame, label: str, count: str, typed: str, least: int = 1) -> DataFrame:
    """Items with a count whose label contains what was typed."""
    return items.where((F.col(count) >= least) & F.contains(F.lower(F.col(label)), F.lit(typed.lower())))


def outline(themes: DataFrame) -> DataFrame:
    """Themes in depth-first order (``position`` from 1) with indented labels."""
    line = F.concat(F.repeat(F.lit("  "), F.col("level") - 1), F.col("code"), F.lit(". "), F.col("description"))
    return numbered(themes.withColumn("line", line).withColumn("__key", natural_key(F.col("code"))), "position", "__key", start=1).drop("__key")


def contains_any(typed: str, *columns: Column) -> Column:
    """Whether one of the texts contains what was typed, in any case; everything does when nothing was typed."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(c), F.lit(typed.lower())), F.lit(False)) for c in columns]) if typed else F.lit(True)


def theme_search(themes: DataFrame, typed: str, label: str = "label") -> DataFrame:
    """Themes whose code, description or label contains what was typed."""
    return themes.where(contains_any(typed, F.col("code"), F.col("description"), F.col(label)))


def with_summaries(themes: DataFrame, summaries: DataFrame) -> DataFrame:
    """Themes that have a summary, with it."""
    return themes.join(summaries.select(F.col("theme_code").alias("code"), "sections", "comment_count"), "code")


def summary_search(rows: DataFrame, typed: str) -> DataFrame:
    """Summarised themes (of :func:`with_summaries`) whose code, label, description or executive summary contains what was typed."""
    return rows.where(contains_any(typed, F.col("code"), F.col("label"), F.col("description"), F.col("sections.executiveSummary")))


# The lists that summaries can be sorted by.
SUMMARY_LISTS = {"consensus": "consensusPoints", "debate": "areasOfDebate", "insights": "noteworthyInsights", "quotes": "keyQuotations"}


def sort_summaries(rows: DataFrame, by: str) -> DataFrame:
    """Summarised themes by code (``theme``), by comments, or by the length of one of their lists."""
    if by == "theme":
        return rows.orderBy("code")
    if by == "comments":
        return rows.orderBy(F.desc("comment_count"), "code")
    return rows.orderBy(F.coalesce(F.size(F.col("sections")[SUMMARY_LISTS[by]]), F.lit(0)).desc(), "code")


def displayed_sections(comments: DataFrame) -> DataFrame:
    """``displayed``: a cluster member shows its representative's sections, where there are any, else its own.

    ``comments``: (``id``, ``sections``, ``is_representative``, ``representative_id``).
    """
    theirs = comments.select(F.col("id").alias("__r"), F.col("sections").alias("__s"))
    asks = F.when(~F.coalesce("is_representative", F.lit(False)), F.col("representative_id"))
    out = comments.withColumn("__asks", asks).join(theirs, F.col("__asks") == F.col("__r"), "left")
    return out.withColumn("displayed", F.coalesce("__s", "sections")).drop("__asks", "__r", "__s")


def direct_themes(scores: Column) -> Column:
    """Codes with score 1 of a map, in the order of their texts."""
    return F.array_sort(F.map_keys(F.map_filter(scores, lambda k, v: v == 1)))


def subtree(themes: DataFrame, code: str) -> DataFrame:
    """A theme and all below it."""
    return themes.where((F.col("code") == code) | F.startswith("code", F.lit(code + ".")))


def up_to_level(themes: DataFrame, level: int = 2) -> DataFrame:
    """Themes of the first levels: what is expanded by default."""
    return themes.where(F.col("level") <= level)


def sort_entities(entities: DataFrame, by: str = "category") -> DataFrame:
    """Entities by ``category`` and mentions (most first), by label (``alpha-asc``, ``alpha-desc``) or mentions (``mentions-asc``, ``mentions-desc``)."""
    if by == "category":
        return entities.orderBy("category", F.desc("mention_count"), "label")
    what, _, way = by.partition("-")
    column = F.col({"alpha": "label", "mentions": "mention_count"}[what])
    return entities.orderBy(column.desc() if way == "desc" else column.asc(), "category", "label")


def categories(entities: DataFrame) -> DataFrame:
    """(``category``, ``entities``, ``mentions``) in order of name."""
    return entities.groupBy("category").agg(F.count("*").alias("entities"), F.sum("mention_count").alias("mentions")).orderBy("category")


def entity_totals(entities: DataFrame) -> DataFrame:
    """Number of entities and of their mentions; 0 without any."""
    return entities.agg(F.count("*").alias("entities"), F.coalesce(F.sum("mention_count"), F.lit(0)).alias("mentions"))


def scored_comments(scores: DataFrame, condensed: DataFrame, most: int = 1) -> DataFrame:
    """(``theme_code``, ``comment_id``, ``structured_sections``, ``score``) of condensed comments with a score up to ``most``, by theme, score and id."""
    rows = scores.where(F.col("score").between(1, most)).select("theme_code", "comment_id", "score").distinct()
    return rows.join(condensed.select("comment_id", "structured_sections"), "comment_id").orderBy("theme_code", "score", "comment_id")


def total_of(rows: DataFrame, *columns: str) -> DataFrame:
    """Sums of columns; 0 for no rows."""
    return rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns))


def type_count(comments: DataFrame, least: int = 5) -> DataFrame:
    """How many submitter types have ``least`` comments or more; a missing type counts as "Unknown"."""
    per = comments.groupBy(F.coalesce(given("submitter_type"), F.lit("Unknown")).alias("t")).agg(F.count("*").alias("n"))
    return per.where(F.col("n") >= least).agg(F.count("*").alias("types"))


def toggle(chosen: list, item) -> list:
    """The list without the item, or with it at the end."""
    return [x for x in chosen if x != item] if item in chosen else [*chosen, item]


def detail_comments(comments: DataFrame) -> DataFrame:
    """Comments that a theme's page lists: representatives and those of no clustering."""
    return comments.where(F.coalesce("is_representative", F.lit(True)))


def comments_for(index: DataFrame, comments: DataFrame, key: Column, ids: str) -> DataFrame:
    """The comments that an index lists under a key, in the index's order."""
    listed = index.where(key).select(F.posexplode(ids).alias("position", "id"))
    return comments.join(listed, "id").orderBy("position")


# An exported comment's sections with their headings, and whether they are on unless chosen otherwise.
COMMENT_SECTIONS = {
    "oneLineSummary": ("Summary", True),
    "corePosition": ("Core Position", True),
    "keyRecommendations": ("Key Recommendations", False),
    "mainConcerns": ("Main Concerns", False),
    "notableExperiences": ("Notable Experiences", False),
    "keyQuotations": ("Key Quotations", True),
}
OTHER_TOGGLES = {"metadata": True, "themeExtracts": True, "detailedContent": False, "themes": True, "entities": True}
EXPORTED_LISTS = {"positions": "Positions", "concerns": "Concerns", "recommendations": "Recommendations", "experiences": "Experiences", "key_quotes": "Key Quotes"}
SUMMARY_SECTIONS = {
    "executiveSummary": "Executive Summary",
    "consensusPoints": "Consensus Points",
    "areasOfDebate": "Areas of Debate",
    "stakeholderPerspectives": "Stakeholder Perspectives",
    "noteworthyInsights": "Noteworthy Insights",
    "emergingPatterns": "Emerging Patterns",
    "keyQuotations": "Key Quotations",
    "analyticalNotes": "Analytical Notes",
}


def comment_toggles(**chosen: bool) -> dict[str, bool]:
    """The 11 sections of an exported comment, as chosen or by default."""
    known = {k: on for k, (_, on) in COMMENT_SECTIONS.items()} | OTHER_TOGGLES
    if unknown := set(chosen) - set(known):
        raise KeyError(f"unknown sections {sorted(unknown)}")
    return known | chosen


def exported_comment(toggles: dict[str, bool]) -> Column:
    """A comment as a Markdown block with the sections that are on.

    Columns: ``id``, ``submitter``, ``submitter_type``, ``date``, ``location``,
    ``sections`` (map), ``extract`` (map of lists), ``theme_scores``, ``entities``.
    """
    who = F.concat_ws(" | ", given("submitter"), given("submitter_type"), given("date"), given("location"))
    head = F.concat(F.lit('<comment id="'), F.col("id"), F.lit('" metadata="'), who, F.lit('">')) if toggles["metadata"] else F.concat(F.lit('<comment id="'), F.col("id"), F.lit('">'))
    parts = []
    for name, (title, _) in COMMENT_SECTIONS.items():
        if toggles[name]:
            parts.append(F.concat(F.lit(f"**{title}:**" + (" " if name == "oneLineSummary" else "\n")), said(F.col("sections"), name)))
    if toggles["themeExtracts"]:
        parts.append(F.concat(F.lit("### Theme-Specific Analysis\n"), given(bullet_lists(F.col("extract"), EXPORTED_LISTS))))
    if toggles["detailedContent"]:
        parts.append(F.concat(F.lit("**Detailed Content:**\n"), said(F.col("sections"), "detailedContent")))
    if toggles["themes"]:
        parts.append(F.concat(F.lit("**Themes:** "), given(F.array_join(direct_themes(F.col("theme_scores")), ", "))))
    if toggles["entities"]:
        named = F.transform("entities", lambda e: F.concat(e.label, F.lit(" ("), e.category, F.lit(")")))
        parts.append(F.concat(F.lit("**Topics:** "), given(F.array_join(named, ", "))))
    body = first_given(F.concat_ws("\n\n", *parts), F.lit("No content available"))
    return F.concat_ws("\n", head, body, F.lit("</comment>"))


def exported_summary(summary: dict, chosen: dict[str, bool] | None = None) -> str:
    """A theme's summary as Markdown with the chosen ones of its eight sections (all by default)."""

    def lines(x, depth: int = 0) -> list[str]:
        if isinstance(x, list):
            return [line for item in x for line in lines(item, depth)]
        if not isinstance(x, dict):
            return [f"{'  ' * depth}- {x}"]
        plain = [f"{v}" for v in x.values() if v and not isinstance(v, (list, dict))]
        inner = [v for v in x.values() if v and isinstance(v, (list, dict))]
        return [f"{'  ' * depth}- {' - '.join(plain)}", *(line for v in inner for line in lines(v, depth + 1))]

    on = dict.fromkeys(SUMMARY_SECTIONS, True) | (chosen or {})
    blocks = []
    for name, title in SUMMARY_SECTIONS.items():
        if on[name] and (x := summary.get(name)):
            blocks.append(f"## {title}\n" + (x if isinstance(x, str) else "\n".join(lines(x))))
    return "\n\n".join(blocks)


def exported(comments: DataFrame, toggles: dict[str, bool], lead_in: str = "", summary: str = "") -> str:
    """One Markdown text: lead-in, summary, then the chosen comments by id.  For a hand-picked set; tables are written with :func:`exported_comment`."""
    rows = [r[0] for r in comments.orderBy("id").select(exported_comment(toggles)).collect()]
    return "\n\n".join(x for x in (lead_in, summary, f"## Comments ({len(rows)})", *rows) if x).strip()
