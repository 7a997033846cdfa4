"""What a Python worker remembers between tasks: one thing at a time."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

Thing = TypeVar("Thing")
_kept: dict[Hashable, object] = {}


def kept(name: Hashable, make: Callable[[], Thing]) -> Thing:
    """The thing of that name, made where it is not there; whatever else was remembered goes first.

    Workers outlive a stage, so the vocabularies of earlier operators would
    otherwise add up.
    """
    found = _kept.get(name)
    if found is None:
        _kept.clear()
        found = _kept[name] = make()
    return found


def forget() -> None:
    """Give up whatever is remembered, for a step that remembers nothing itself."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
