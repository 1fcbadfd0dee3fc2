"""Answers outlive the tasks that got them."""

import collections
import json

import pytest

from dockmill.operators import answers
from dockmill.operators.generate import PROVIDERS, generate


def asked_prompts(folder):
    return collections.Counter(line for f in folder.iterdir() for line in f.read_text().splitlines())


def test_no_prompt_is_asked_twice(spark, tmp_path):
    calls, ready = tmp_path / "calls", tmp_path / "ready"
    calls.mkdir()

    def provider(prompt):
        import os
        import uuid

        (calls / uuid.uuid4().hex).write_text(prompt)
        if prompt == "p17" and not os.path.exists(ready):
            raise ValueError("the provider broke")
        return "" if prompt == "p3" and not os.path.exists(ready) else f"answer to {prompt}"

    PROVIDERS["breaks"] = provider
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "id long, prompt string").coalesce(1).sortWithinPartitions("id")
    log = f"file://{tmp_path}/log"
    with pytest.raises(Exception, match="the provider broke"):
        generate(prompts, "prompt", "breaks", log=log)
    first = asked_prompts(calls)
    assert 0 < len(first) < 40 and set(first.values()) == {1} | {first["p17"]}
    ready.touch()
    rows, fresh = generate(prompts, "prompt", "breaks", log=log)
    assert {r.prompt: r.result for r in rows.collect()} == {f"p{i}": f"answer to p{i}" for i in range(40)} and fresh.count() == 40
    again = {p for p, n in asked_prompts(calls).items() if n > first.get("p17", 1)}
    assert {p for p, n in asked_prompts(calls).items() if n > 1} <= {"p17", "p3"} and not again - {"p17", "p3"}
    generate(prompts, "prompt", "breaks", log=log)
    assert sum(asked_prompts(calls).values()) <= 40 + first["p17"] + 1


def test_a_log_cut_off_is_read_to_there(tmp_path):
    writer = answers._Writer(f"file://{tmp_path}", str.upper)
    (tmp_path / "7").mkdir()
    (tmp_path / "7" / "x.json").write_text(json.dumps({"prompt_hash": "a", "result": "kept"}) + '\n{"prompt_hash": "b", "re')
    got = writer.write(iter([{"prompt_hash": "a", "payload": "x", "bucket": 7}, {"prompt_hash": "c", "payload": "y", "bucket": 9}]))
    assert (got.asked, got.found) == (1, 1) and writer._known(9) == {"c": "Y"} and writer._known(1) == {}
