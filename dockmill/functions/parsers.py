"""Parsers of generated outlines: theme and entity taxonomies.

An outline is cut into sections at its head lines; what a head line looks like
is a regex, so themes, categories and entities go through the same function.
Segmentation of whole tables stays in the JVM (:func:`theme_segments`); the
label rules run on the driver-sized texts they are for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.functions.text import level_of, parent_of, trim_space

# Abbreviations whose full stop does not end a sentence.
ABBREVIATIONS = ["U.S.", "U.K.", "Dr.", "Mr.", "Mrs.", "Ms.", "Prof.", "Inc.", "Ltd.", "Corp.", "vs.", "e.g.", "i.e.", "etc."]

# Fixed value: the label rule of parity mode, quirks included (no label ends in v or s, nor has U, S or a stop before its last character).
PARITY_LABEL = re.compile(r"^(.+?[^U.S][^vs])\.\s+([A-Z].*)\Z", re.DOTALL)

# An abbreviation is consumed whole, so the stops that are left over end sentences.
_STOPS = re.compile(r"(?<!\w)(?:%s)|(\.)" % "|".join(map(re.escape, ABBREVIATIONS)))
_THEME = re.compile(r"(?m)^(?P<head>\d+(?:\.\d+)*)\.\s+")
_CATEGORY = re.compile(r"(?m)^[^\S\n]*\d+\.[^\S\n]+(?P<head>.*\S)[^\S\n]*$")
_ENTITY = re.compile(r"(?m)^[^\S\n]*\*[^\S\n]+(?P<head>[^:\n]+:[^\S\n]+.*\S)[^\S\n]*$")
_TERM = re.compile(r'(?m)^[^\S\n]*\*[^\S\n]+"?([^"\n]+)"?[^\S\n]*$')


def _sections(text: str, head: re.Pattern) -> Iterator[tuple[str, str]]:
    """(head, text up to the next head); what stands before the first head belongs to none."""
    found = list(head.finditer(text))
    for m, stop in zip(found, [*(m.start() for m in found[1:]), len(text)]):
        yield m["head"], text[m.end() : stop]


def sentence_ends(text: str) -> Iterator[int]:
    """Places of full stops that belong to no abbreviation."""
    return (m.start() for m in _STOPS.finditer(text) if m[1])


@dataclass
class Theme:
    code: str
    description: str
    level: int
    parent_code: str | None
    detailed_guidelines: str


def _clean_label(body: str) -> tuple[str, str]:
    """Label and rest at the first sentence end before white space."""
    for at in sentence_ends(body):
        if body[at + 1 : at + 2].isspace():
            return body[:at], body[at + 1 :].lstrip()
    return body.removesuffix("."), ""


def _parity_label(body: str) -> tuple[str, str]:
    """Label and rest by the parity rule; where it finds none, at the first stop, or the second after " U.S" or " vs"."""
    if m := PARITY_LABEL.match(body):
        return m[1], m[2]
    label, *rest = re.split(r"\.\s+", body)
    if rest and re.search(r" (U\.S|vs)\Z", label):
        label = f"{label}. {rest.pop(0)}"
    return label, ". ".join(rest)


_LABELS = {"clean": _clean_label, "parity": _parity_label}


def _guidelines(rest: str) -> str:
    """Brief description and details as sentences: they part at a double bar, else at a stop among the first 200 characters."""
    rest = rest.strip()
    border = re.search(r" \|\| ", rest) or re.compile(r"\. ").search(rest, 1, 201)
    if border is None:
        return rest.removesuffix(".")
    brief, more = rest[: border.start()].strip().removesuffix("."), rest[border.end() :].strip()
    return f"{brief}. {more}" if more else brief


def parse_themes(text: str, mode: str = "clean") -> list[Theme]:
    """Themes of an outline whose paragraphs start with dotted numbers."""
    out = []
    for code, body in _sections(text, _THEME):
        label, rest = _LABELS[mode](body.strip())
        parent, _, _ = code.rpartition(".")
        out.append(Theme(code, label.strip(), 1 + code.count("."), parent or None, _guidelines(rest)))
    return out


def theme_segments(outlines: DataFrame, text: str) -> DataFrame:
    """(``code``, ``level``, ``parent_code``, ``body``) of outlines, in the JVM."""
    parts = F.filter(F.split(F.regexp_replace(text, r"(?m)^(\d+(?:\.\d+)*)\.\s+", "\u0001$1\u0002"), "\u0001"), lambda p: F.contains(p, F.lit("\u0002")))
    rows = outlines.select(F.explode(parts).alias("p")).select(F.split("p", "\u0002").alias("s"))
    code = F.get("s", F.lit(0))
    return rows.select(code.alias("code"), level_of(code).alias("level"), parent_of(code).alias("parent_code"), trim_space(F.get("s", F.lit(1))).alias("body"))


@dataclass
class Entity:
    label: str
    definition: str
    terms: list[str] = field(default_factory=list)


def _entity(head: str, body: str) -> Entity:
    label, _, definition = head.partition(":")
    return Entity(label.strip(), definition.strip(), [t.strip() for t in _TERM.findall(body)])


def parse_entities(text: str) -> dict[str, list[Entity]]:
    """Categories ("1. Name"), their entities ("* Label: definition"), and the entities' terms ("* term")."""
    out: dict[str, list[Entity]] = {}
    for name, body in _sections(text, _CATEGORY):
        out.setdefault(name, []).extend(_entity(*e) for e in _sections(body, _ENTITY))
    return out


def split_description(description: str) -> tuple[str, str]:
    """(label, details) at the first sentence end; all is label if nothing stands on one side of it or in another line."""
    at = next(sentence_ends(description), 0)
    label, details = description[:at].strip(), description[at + 1 :].strip()
    return (label, details) if label and details and "\n" not in details else (description, "")


def fill(template: str, **values: str) -> str:
    """Each ``{NAME}`` replaced literally."""
    return re.sub(r"\{([A-Z_]+)\}", lambda m: values.get(m.group(1), m.group(0)), template)
