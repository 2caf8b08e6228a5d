"""Fast pre-tokens: texts are cut at single spaces, and what a chunk becomes is looked up in a bounded cache."""

from __future__ import annotations

import re
from collections.abc import Callable

from candlemill.llm.common import shipped

shipped(__name__)

LIMIT = 200_000  # entries of a task's cache
CLASH = re.compile(r"\s \s|\s \Z")


def chunks(text: str) -> tuple[str, list[str]] | None:
    """What stands before the first space, and what stands between each space and the next; None where a pre-token may
    cross such a cut.

    A run of letters, digits or other characters starts with at most one space, so a cut before a space never divides
    it. Runs of white space are divided only where white space stands on both sides of a space.
    """
    if CLASH.search(text):
        return None
    first, *rest = text.split(" ")
    return first, rest


def lookup(cache: dict, keys: list[str], make: Callable[[list[str]], list]) -> list:
    """The cache's values of the keys, none of which is None; ``make`` gives those of the missing ones."""
    found = list(map(cache.get, keys))
    missing = list(dict.fromkeys(k for k, v in zip(keys, found) if v is None))
    if not missing:
        return found
    made = dict(zip(missing, make(missing)))
    found = [made[k] if v is None else v for k, v in zip(keys, found)]
    if len(cache) + len(made) > LIMIT:
        cache.clear()
    cache.update(made)
    return found
