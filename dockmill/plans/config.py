"""Settings of tasks: task over global, with a multiplier by model."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Task:
    concurrency: int = 5
    merge_width: int = 10
    trigger_words: int = 250_000
    batch_words: int = 150_000
    model: str = "stub"


@dataclass(frozen=True)
class Config:
    defaults: Task = Task()
    tasks: dict[str, dict] = field(default_factory=dict)
    multipliers: dict[str, float] = field(default_factory=dict)

    def task(self, name: str) -> Task:
        """The task's settings; concurrency is scaled by the model's multiplier."""
        t = replace(self.defaults, **self.tasks.get(name, {}))
        return replace(t, concurrency=max(1, round(t.concurrency * self.multipliers.get(t.model, 1.0))))


def load_config(path: str | None = None) -> Config:
    """From a JSON file with ``global``, ``tasks`` and ``models``; defaults without one."""
    if path is None:
        return Config()
    with open(path) as f:
        raw = json.load(f)
    known = set(Task.__dataclass_fields__)
    pick = lambda d: {k: v for k, v in d.items() if k in known}
    return Config(replace(Task(), **pick(raw.get("global", {}))), {k: pick(v) for k, v in raw.get("tasks", {}).items()}, {k: v.get("multiplier", 1.0) for k, v in raw.get("models", {}).items()})
