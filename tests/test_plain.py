"""Parsers, search strings, runners and settings: no session needed."""

import json

import pytest

from dockmill.functions.parsers import fill, parse_entities, parse_themes, split_description
from dockmill.operators.batching import merge_tree
from dockmill.operators.explore import parse_search, prefix_of, search_string, without
from dockmill.operators.generate import Busy, provider, repair_ids, with_retry, with_timeout
from dockmill.plans.config import load_config
from dockmill.plans.runner import Node, levels, retry_delay, run_levels, run_steps
from dockmill.sources.api import backoff
from dockmill.sources.bulk import is_file
from dockmill.sources.files import list_collections


def groups(q, mode="documented"):
    return [(t.value, t.negated, t.group) for t in parse_search(q, mode)]


def test_search_strings():
    assert groups("a OR b") == [("a", False, 0), ("b", False, 0)]
    assert groups("a OR b", "parity") == [("a", False, 0), ("b", False, 1)]
    assert groups("- x --y") == [("x", False, 0), ("-y", True, 1)] and groups("orange \"\" corn") == [("orange", False, 0), ("corn", False, 1)]
    assert groups('"foo bar') == [("foo bar", False, 0)]
    assert groups('OR a -"b c" or d') == [("OR", False, 0), ("a", False, 1), ("b c", True, 2), ("d", False, 2)]
    for q in ("a OR b c", '-"x y" z', "a"):
        assert groups(search_string(parse_search(q))) == groups(q)
    assert [t.group for t in without(parse_search("a b OR c d"), 0)] == [0, 0, 1]
    assert prefix_of("foo theme:he") == ("theme", "he", "foo") and prefix_of("foo") == (None, "", "foo")


def test_theme_outline():
    text = "1. Burden Concerns. This theme is about costs. It matters a lot. End || G"
    assert parse_themes(text)[0].description == "Burden Concerns"
    assert parse_themes(text, "parity")[0].description == "Burden Concerns. This theme is about costs. It matters a lot"
    abbr = parse_themes("2. Harm to U.S. Citizens Abroad. This theme covers it. || Z\n3.1.2. X. Y")
    assert abbr[0].description == "Harm to U.S. Citizens Abroad"
    assert (abbr[1].code, abbr[1].level, abbr[1].parent_code) == ("3.1.2", 3, "3.1")
    assert parse_themes("no outline") == []
    assert split_description("Harm to U.S. Citizens. It is big.") == ("Harm to U.S. Citizens", "It is big.")
    assert split_description("plain") == ("plain", "")


def test_entity_outline():
    got = parse_entities('1. Agencies\n* CMS: The agency\n  * "CMS"\n  * Centers\n2. Laws\n* stray')
    assert [e.terms for e in got["Agencies"]] == [["CMS", "Centers"]] and got["Laws"] == []
    more = parse_entities('* early: x\n 1. A b \r\n\t* L m : d: e \n* t\n1. A b\n* N: o')
    assert [(e.label, e.definition, e.terms) for e in more["A b"]] == [("L m", "d: e", ["t"]), ("N", "o", [])]
    assert parse_entities("no outline") == {}


def test_labels_and_guidelines():
    assert split_description("Costs. Two. Three") == ("Costs", "Two. Three") and split_description("See e.g. this. That") == ("See e.g. this", "That")
    assert split_description("ATMs. More") == ("ATMs", "More") and split_description(". x") == (". x", "") and split_description("x.") == ("x.", "")
    themes = parse_themes("intro\n1. A. Brief one. More text here.\n1.1. B. Long || Detail || x\n2. C only\n10.2.3. Dr. No speaks. End.")
    assert [(t.code, t.description, t.detailed_guidelines) for t in themes] == [("1", "A", "Brief one. More text here."), ("1.1", "B", "Long. Detail || x"), ("2", "C only", ""), ("10.2.3", "Dr. No speaks", "End")]
    assert parse_themes("1. Fight vs. Costs. Rest", "parity")[0].description == "Fight vs. Costs"


def test_runners():
    nodes = [Node("a"), Node("b", ("a",)), Node("c", ("a",)), Node("d", ("b", "c"))]
    assert levels(nodes) == [["a"], ["b", "c"], ["d"]]
    assert run_levels(nodes, lambda i, done: i + "".join(sorted(done)), 2)["d"] == "dabc"
    with pytest.raises(ValueError, match="cycle"):
        levels([Node("a", ("b",)), Node("b", ("a",))])
    tries = []

    def shaky():
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError('429 {"error": "{\\"retryDelay\\": \\"7s\\"}"}')

    waits = []
    assert run_steps([("x", shaky), ("y", lambda: None)], sleep=waits.append) == ["x", "y"] and waits == [9.0, 9.0]
    assert run_steps([("x", shaky), ("y", lambda: None)], start=2) == ["y"]
    assert retry_delay("429 no json", 5.0) == 5.0 and retry_delay('500 {"retryDelay": "7s"}', 5.0) == 5.0
    assert [len(x) for x in merge_tree(11, 10)[0]] == [6, 5]


@pytest.mark.parametrize("n", range(2, 60, 7))
@pytest.mark.parametrize("width", [2, 4, 10])
def test_merge_tree_keeps_all(n, width):
    first = merge_tree(n, width)[0]
    assert sorted(x for g in first for x in g) == list(range(n))
    assert max(map(len, first)) - min(map(len, first)) <= 1 and max(map(len, first)) <= width


def test_providers():
    calls = []

    def busy(p):
        calls.append(p)
        if len(calls) < 3:
            raise Busy
        return "done"

    assert with_retry(busy, sleep=lambda s: None)("x") == "done" and len(calls) == 3
    assert with_timeout(lambda p: p, 5)("x") == "x"
    with pytest.raises(KeyError):
        provider("nothing")


def test_id_repair():
    known, unique = {"X-0232", "X-0241"}, {"0232": "X-0232"}
    got = repair_ids({"commentId": "-0232", "more": [{"commentIds": ["0232", "X-0241", "9"]}], "other": "0232"}, known, unique)
    assert got == {"commentId": "X-0232", "more": [{"commentIds": ["X-0232", "X-0241", "9"]}], "other": "0232"}


def test_settings(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"global": {"concurrency": 5}, "tasks": {"extract": {"concurrency": 10, "model": "m"}}, "models": {"m": {"multiplier": 2}}}))
    assert load_config(str(path)).task("extract").concurrency == 20 and load_config().task("x").concurrency == 5
    assert [backoff(i) for i in (0, 1, 9)] == [5.0, 10.0, 120.0]
    assert is_file("a/b") and is_file("x.csv") and not is_file("DOC.1")
    assert list_collections(["a.sqlite", "a.sqlite-wal", "b.sqlite.bak", "c.txt"]) == ["a"]
    assert fill("{X} $& {Y}", X="$1") == "$1 $& {Y}"
