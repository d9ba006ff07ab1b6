"""Models kept for the lifetime of a Python worker."""

from __future__ import annotations

from collections.abc import Callable

_loaded: dict[str, tuple] = {}


def get(key: str, load: Callable[[], tuple]) -> tuple:
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]
