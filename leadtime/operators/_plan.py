"""Small plan helpers shared by operators."""

from __future__ import annotations


def as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)
