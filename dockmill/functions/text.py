"""Scalar text functions as Column builders; all stay in the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of ECMAScript's \s, for Java's regexes.
SPACE = r"[\s   -     　﻿]"

# Its characters.
SPACES = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

# Phrases that mark an item without content.
PLACEHOLDERS = [
    "nothing to extract",
    "no relevant",
    "no specific",
    "not addressed",
    "not discussed",
    "not mentioned",
    "no information",
    "no content",
    "the commenter did not",
    "the commenter does not",
]

# Section headers and the fields they fill.
SECTIONS = {
    "ONE-LINE SUMMARY": "oneLineSummary",
    "COMMENTER PROFILE": "commenterProfile",
    "CORE POSITION": "corePosition",
    "KEY RECOMMENDATIONS": "keyRecommendations",
    "MAIN CONCERNS": "mainConcerns",
    "NOTABLE EXPERIENCES & INSIGHTS": "notableExperiences",
    "KEY QUOTATIONS": "keyQuotations",
}

# Endings of a description that was cut at an abbreviation.
CUT_ENDINGS = ["U.S", "U.K", "vs", "Dr", "Mr", "Mrs", "Ms", "Inc", "Ltd", "Corp"]

# Organization kinds.
ORGANIZATION_TYPES = ["Organization", "Business", "Healthcare Organization", "Government Agency", "Trade Association"]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def given(x: Column | str) -> Column:
    """NULL for an empty string, else the value: what a truthiness test keeps."""
    x = F.col(x) if isinstance(x, str) else x
    return F.nullif(x, F.lit(""))


def first_given(*xs: Column | str) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*(given(x) for x in xs))


def trim_space(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def tokens(x: Column) -> Column:
    """Non-empty runs between white space."""
    return F.filter(F.split(x, f"{SPACE}+"), lambda w: w != "")


def word_count(x: Column) -> Column:
    """Number of words; 0 for NULL and blank."""
    return F.coalesce(F.size(tokens(x)), F.lit(0))


def split_count(x: Column) -> Column:
    """Number of parts when split at white space, empty ones included: 1 for a blank text."""
    return F.size(F.split(x, f"{SPACE}+"))


def normal_words(x: Column, longer_than: int = 1) -> Column:
    """Lower-cased runs of ``[a-z0-9_]`` with more than ``longer_than`` characters."""
    return F.filter(F.split(F.lower(x), "[^a-z0-9_]+"), lambda w: F.length(w) > longer_than)


def ngrams(words: Column, n: int) -> Column:
    """``n<k>:`` followed by the words of each window; none if there are too few words."""
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.concat(F.lit(f"n{n}:"), F.array_join(F.slice(words, i + 1, n), " ")))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def features(x: Column, mode: str = "word-ngrams", low: int = 3, high: int = 5) -> Column:
    """Distinct features of a text in order of first appearance: words, word n-grams, or both."""

    def of(words: Column) -> Column:
        parts = []
        if mode in ("words", "both"):
            parts.append(F.transform(F.filter(words, lambda w: F.length(w) > 2), lambda w: F.concat(F.lit("w:"), w)))
        if mode in ("word-ngrams", "both"):
            parts += [ngrams(words, n) for n in range(low, high + 1)]
        return F.array_distinct(F.concat(*parts))

    return let(normal_words(x), of)


def feature_ids(x: Column, mode: str = "word-ngrams", low: int = 3, high: int = 5) -> Column:
    """:func:`features` as 64-bit hashes, in the same order.

    Words are hashed once and a window's hash is made of theirs, so no text is
    built.  Sets of ids compare like sets of features, but for equal hashes of
    different features (2**-64 a pair).
    """

    def windows(h: Column, n: int) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(F.lit(n), *(F.get(h, i + j) for j in range(n))))
        return F.when(F.size(h) >= n, grams).otherwise(F.array().cast("array<bigint>"))

    def of(words: Column) -> Column:
        parts = []
        if mode in ("words", "both"):
            parts.append(F.transform(F.filter(words, lambda w: F.length(w) > 2), lambda w: F.xxhash64(F.lit(1), w)))
        if mode in ("word-ngrams", "both"):
            parts.append(let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.concat(*(windows(h, n) for n in range(low, high + 1)))))
        return F.array_distinct(F.concat(*parts))

    return let(normal_words(x), of)


def sections(x: Column) -> Column:
    """Map from field to content of ``### HEADER`` sections; of a repeated header the last counts."""
    parts = F.slice(F.split(x, r"(?m)^###\s+"), 2, 1_000_000)
    known = F.create_map(*(F.lit(v) for kv in SECTIONS.items() for v in kv))

    def entry(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        return F.struct(F.element_at(known, F.upper(F.trim(head))).alias("key"), trim_space(F.substr(p, F.length(head) + 2)).alias("value"))

    pairs = F.filter(F.transform(parts, entry), lambda e: e.key.isNotNull())
    return let(pairs, _last_entries)


def _last_entries(pairs: Column) -> Column:
    """A map of (key, value) pairs; of a repeated key the last counts."""
    return F.map_from_entries(F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, 1_000_000), lambda later: later.key == e.key)))


def missing_sections(found: Column) -> Column:
    """Headers whose section is absent, in their order."""
    known = F.create_map(*(F.lit(v) for kv in SECTIONS.items() for v in kv))
    return let(found, lambda m: F.filter(F.array(*(F.lit(h) for h in SECTIONS)), lambda h: ~F.map_contains_key(m, F.element_at(known, h))))


def section_errors(x: Column) -> Column:
    """Messages about text before the first section, unknown headers and missing ones."""
    parts = F.split(x, r"(?m)^###\s+")
    intro = trim_space(F.get(parts, F.lit(0)))
    heads = F.transform(F.slice(parts, 2, 1_000_000), lambda p: F.trim(F.substring_index(p, "\n", 1)))
    known = F.array(*(F.lit(h) for h in SECTIONS))
    unknown = F.transform(F.filter(heads, lambda h: ~F.array_contains(known, F.upper(h))), lambda h: F.concat(F.lit('Unknown section header: "'), h, F.lit('"')))
    absent = missing_sections(sections(x))
    none = F.array().cast("array<string>")
    return F.concat(
        F.when((intro != "") & ~intro.startswith("#"), F.array(F.concat(F.lit('Unexpected content before first section: "'), F.substring(intro, 1, 50), F.lit('..."')))).otherwise(none),
        unknown,
        F.when(F.size(absent) > 0, F.array(F.concat(F.lit("Missing required sections: "), F.array_join(absent, ", ")))).otherwise(none),
    )


def bullets(x: Column) -> Column:
    """Texts of lines that start with ``- `` after trimming."""
    return F.transform(F.filter(F.transform(F.split(x, "\n"), trim_space), lambda s: s.startswith("- ")), lambda s: F.trim(F.substr(s, F.lit(3))))


def profile(x: Column) -> Column:
    """Map of ``- **Key:** value`` lines; keys keep their letters only, lower-cased."""
    lines = F.filter(F.split(x, "\n"), lambda s: s.rlike(r"^\s*-\s*\*\*[^:*]+:\*\*"))
    entries = F.transform(lines, lambda s: F.struct(F.regexp_replace(F.lower(F.regexp_extract(s, r"\*\*([^:*]+):\*\*", 1)), "[^a-z]", "").alias("key"), F.trim(F.regexp_extract(s, r":\*\*\s*(.*)$", 1)).alias("value")))
    return let(entries, _last_entries)


def unquote(x: Column) -> Column:
    """Without one pair of surrounding double quotes."""
    return F.when((F.length(x) >= 2) & x.startswith('"') & x.endswith('"'), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x)


def json_body(x: Column) -> Column:
    """The first fenced block, else from the first ``{`` to the last ``}``; NULL without either."""
    fenced = F.regexp_extract(x, r"```(?:json)?\s*([\s\S]*?)```", 1)
    first, last = F.instr(x, "{"), F.length(x) - F.instr(F.reverse(x), "}") + 1
    braces = F.when((first > 0) & (F.instr(x, "}") > 0) & (last > first), F.substr(x, first, last - first + 1))
    return F.coalesce(given(trim_space(fenced)), braces)


def weak(x: Column) -> Column:
    """Whether an item says nothing: short with the word "no", or one of the placeholder phrases."""

    def of(low: Column) -> Column:
        short = let(tokens(low), lambda words: (F.size(words) < 20) & F.array_contains(words, "no"))
        return reduce(lambda a, b: a | b, (F.contains(low, F.lit(p)) for p in PLACEHOLDERS), F.contains(low, F.lit("no")) & short)

    return let(F.lower(x), of)


def clean_items(items: Column) -> Column:
    return F.filter(items, lambda t: ~weak(t))


def clean_extract(extract: Column) -> Column:
    """Known sections of a map of item lists without weak items and empty sections; NULL if nothing is left."""
    known = F.array(*(F.lit(s) for s in ("positions", "concerns", "recommendations", "experiences", "key_quotes")))
    kept = F.map_filter(F.transform_values(F.map_filter(extract, lambda k, v: F.array_contains(known, k) & v.isNotNull()), lambda k, v: clean_items(v)), lambda k, v: F.size(v) > 0)
    return let(kept, lambda m: F.when(F.size(m) > 0, m))


def cut_description(x: Column) -> Column:
    """Whether a description looks cut: it ends in an abbreviation, or is short without a full stop."""
    ends = F.lit(False)
    for e in CUT_ENDINGS:
        ends = ends | x.ilike(f"% {e}")
    return ends | ((F.length(x) < 50) & ~F.contains(x, F.lit(".")))


def first_sentence(x: Column) -> Column:
    """Up to the first full stop and space, one part further if that ends in an abbreviation."""
    parts = F.split(x, r"\.\s+")
    first = F.get(parts, F.lit(0))
    cut = F.exists(F.array(*(F.lit(f" {e}") for e in CUT_ENDINGS)), lambda e: F.endswith(first, e))
    return F.when(F.size(parts) < 2, F.lit(None)).when(cut, F.concat(first, F.lit(". "), F.get(parts, F.lit(1)))).otherwise(first)


def repaired_description(description: Column, guidelines: Column) -> Column:
    """The label inside the guidelines ("X. This theme ..."), where there is one."""
    return F.coalesce(given(F.regexp_extract(guidelines, r"^(.+?)\.\s+This theme", 1)), description)


def patched_description(description: Column, guidelines: Column) -> Column:
    """A description that looks cut is replaced by its guidelines' first sentence, where they have one."""
    return F.when(cut_description(description), F.coalesce(given(first_sentence(guidelines)), description)).otherwise(description)


def preview(x: Column) -> Column:
    """At most 100 characters of the first 200, with dots if cut."""
    head = F.substring(x, 1, 200)
    return F.when(F.length(head) > 100, F.concat(F.substring(head, 1, 100), F.lit("..."))).otherwise(head)


def leading_int(x: Column) -> Column:
    """The integer a text starts with; NULL without one."""
    return F.nullif(F.regexp_extract(x, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("int")


def basename(x: Column) -> Column:
    return F.element_at(F.split(x, "/"), -1)


def extension(x: Column, default: str = "bin") -> Column:
    """Lower-cased letters and digits after the last dot of the base name."""
    return F.coalesce(given(F.lower(F.regexp_extract(F.regexp_replace(x, r"[?#].*$", ""), r"\.([A-Za-z0-9]+)$", 1))), F.lit(default))


def level_of(code: Column) -> Column:
    return F.size(F.split(code, r"\."))


def parent_of(code: Column) -> Column:
    """The code without its last part; NULL at the top."""
    return F.when(F.contains(code, F.lit(".")), F.regexp_replace(code, r"\.[^.]*$", ""))


def natural_key(code: Column) -> Column:
    """Sort key of a dotted code: number parts as numbers, before others, which compare as texts; shorter codes first."""
    return F.transform(F.split(code, r"\."), lambda p: F.struct(p.try_cast("decimal(38,0)").isNull().alias("is_text"), p.try_cast("decimal(38,0)").alias("number"), F.lower(p).alias("low"), p.alias("text")))


def date_part(x: Column) -> Column:
    return F.get(F.split(x, "T"), F.lit(0))


def nice_date(x: Column) -> Column:
    return F.date_format(F.to_date(date_part(x)), "MMM d, yyyy")


def badge(n: Column) -> Column:
    return F.when(n > 100, "very-high").when(n > 50, "high").when(n > 20, "medium").otherwise("low")


def size_label(n: Column) -> Column:
    return F.when(n >= 100, "form letter").when(n >= 10, "cluster").when(n > 1, "small cluster").otherwise("individual")


def stage_label(summaries: Column, scored: Column, themes: Column, condensed: Column, comments: Column) -> Column:
    return F.when(summaries > 0, "Complete").when(scored > 0, "Themes Scored").when(themes > 0, "Themes Discovered").when(condensed > 0, "Condensed").when(comments > 0, "Comments Loaded").otherwise("Not Started")


def record_url(base: str, record_id: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), record_id)


def bounded(term: str) -> str:
    """A Java regex for a term at word boundaries in the ASCII sense.

    Beside a word character there must be none; beside any other edge of the
    term there must be one.
    """
    word = "[A-Za-z0-9_]"
    before = f"(?<!{word})" if re.match(word, term) else f"(?<={word})"
    after = f"(?!{word})" if re.search(word + r"\Z", term) else f"(?={word})"
    return before + r"\Q" + term.replace(r"\E", r"\E\\E\Q") + r"\E" + after


def entity_keys(entities: Column) -> Column:
    """``category|label`` of an array of entities."""
    return F.transform(entities, lambda e: F.concat_ws("|", e.category, e.label))


def is_organization(kind: Column) -> Column:
    return F.coalesce(kind.isin(ORGANIZATION_TYPES), F.lit(False))


def unwrapped_extract(x: Column) -> Column:
    """The ``extract`` inside a JSON object, or the object itself; NULL for what is no JSON."""
    inner = F.get_json_object(x, "$.extract")
    return F.when(F.try_parse_json(x).isNotNull(), F.coalesce(given(inner), x))


def valid_json(x: Column) -> Column:
    """The JSON body of an answer; NULL where it has none or it can't be parsed."""
    return let(json_body(x), lambda body: F.when(F.try_parse_json(body).isNotNull(), body))


def head_of(items: Column, k: int) -> Column:
    """(``shown``, ``more``): the first ``k`` of a list and how many follow."""
    return F.struct(F.slice(items, 1, k).alias("shown"), F.greatest(F.size(items) - k, F.lit(0)).alias("more"))


def submitter(org: str, first: str, last: str) -> Column:
    names = F.concat_ws(" ", given(first), given(last))
    return F.coalesce(given(org), given(names), F.lit("Anonymous"))


def location(city: str | None, state: str, country: str, hide: str | None = "United States") -> Column:
    shown = given(country) if hide is None else F.when(F.col(country) != hide, given(country))
    return given(F.concat_ws(", ", *([given(city)] if city else []), given(state), shown))
