"""Results that a worker keeps, bounded by bytes."""

from __future__ import annotations

from collections.abc import Callable

#: Longer keys are not kept: they hardly come again.
LONGEST = 40
#: Bytes that an entry with a key of at most that length takes, with its place in the dictionary (most take half of it).
_ENTRY = 400


class Kept(dict):
    """Remembers what ``make`` returns, and of two spans of use the last: what is used again stays.

    Both spans together take about ``most_bytes``. Keys are strings or bytes; values grow with their keys' lengths.
    """

    def __init__(self, make: Callable, most_bytes: int, longest: int = LONGEST):
        super().__init__()
        self.make, self.most, self.longest = make, max(most_bytes // (2 * _ENTRY), 1), longest
        self.before: dict = {}

    def __missing__(self, key):
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > self.longest:
                return found
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found

    def forget(self) -> None:
        """Drop both spans of use."""
        self.clear()
        self.before = {}
