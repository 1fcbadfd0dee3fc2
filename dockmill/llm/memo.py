"""What worker processes remember between batches; a worker that turns to another operator forgets the rest."""

from __future__ import annotations

from collections.abc import Callable

_clear: dict[str, Callable[[], None]] = {}


def register(owner: str, clear: Callable[[], None]) -> None:
    _clear[owner] = clear


def only(owner: str) -> None:
    """Forget what other operators remembered in this process."""
    for name, clear in _clear.items():
        if name != owner:
            clear()
