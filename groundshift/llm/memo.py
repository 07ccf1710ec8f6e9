"""A bounded cache of a function of a word."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from typing import Any


class Memo(dict):
    """``memo[key]`` is ``fn(key)``, computed once while the key stays in use.

    Keys are held in two generations of at most ``limit`` together; when the
    newer one is half the limit it becomes the older one. Long keys are not kept.
    """

    def __init__(self, fn: Callable[[Any], Any], limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.fn, self.limit, self.longest, self.older = fn, limit, longest, {}

    def missing(self, keys: Iterable[Hashable]) -> list:
        """The distinct keys that have no value."""
        return [k for k in set(keys) if k not in self and k not in self.older]

    def put(self, key: Hashable, value: Any) -> None:
        if len(key) <= self.longest:
            if len(self) * 2 >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value

    def __missing__(self, key: Hashable):
        value = self.older.get(key)
        if value is None:
            value = self.fn(key)
        self.put(key, value)
        return value
