"""Driver-side runners: dependency levels, bounded pool, restarts."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass


@dataclass(frozen=True)
class Node:
    id: str
    dependencies: tuple[str, ...] = ()


def levels(nodes: list[Node]) -> list[list[str]]:
    """Ids by level: each level needs earlier ones only.  Raises on a cycle or an unknown dependency."""
    left, done, out = {n.id: set(n.dependencies) for n in nodes}, set(), []
    if unknown := set().union(*left.values(), set()) - set(left):
        raise ValueError(f"unknown dependencies: {sorted(unknown)}")
    while left:
        ready = [i for i, needs in left.items() if needs <= done]
        if not ready:
            raise ValueError(f"cycle among {sorted(left)}")
        out.append(ready)
        done.update(ready)
        for i in ready:
            del left[i]
    return out


def run_levels(nodes: list[Node], work: Callable[[str, dict], object], concurrency: int = 1, progress: Callable[[str], None] | None = None) -> dict[str, object]:
    """Results by id; jobs of one level run side by side, and the first failure ends the run."""
    results: dict[str, object] = {}
    for level in levels(nodes):
        with ThreadPoolExecutor(max(1, concurrency)) as pool:
            for i, r in zip(level, pool.map(lambda i: work(i, results), level), strict=True):
                results[i] = r
                if progress:
                    progress(i)
    return results


def run_steps(steps: list[tuple[str, Callable[[], object]]], start: int = 1, crashes: int = 10, delay: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> list[str]:
    """Run steps in order from ``start`` (1 to the number of steps); a step that fails is run again, ``crashes`` times in all."""
    if not 1 <= start <= len(steps):
        raise ValueError(f"start must be 1 to {len(steps)}")
    done: list[str] = []
    at = start - 1
    while at < len(steps):
        name, step = steps[at]
        try:
            step()
        except Exception as e:
            crashes -= 1
            if crashes < 0:
                raise
            sleep(retry_delay(str(e), delay))
            continue
        done.append(name)
        at += 1
    return done


def retry_delay(message: str, default: float) -> float:
    """Two seconds more than a 429 error's JSON asks to wait (``retryDelay``: "12s"), anywhere inside it."""

    def find(x) -> float | None:
        if isinstance(x, str) and x.lstrip().startswith(("{", "[")):
            try:
                x = json.loads(x)
            except ValueError:
                return None
        if isinstance(x, dict):
            if isinstance(d := x.get("retryDelay"), str) and (m := re.fullmatch(r"(\d+(?:\.\d+)?)s", d)):
                return float(m.group(1))
            x = list(x.values())
        return next((f for v in x if (f := find(v)) is not None), None) if isinstance(x, list) else None

    at = message.find("{")
    found = find(message[at : message.rfind("}") + 1]) if at >= 0 and "429" in message else None
    return default if found is None else int(found) + 2.0
