"""Cutting texts where no token can cross, so that every distinct unit is encoded once a task."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np

#: Bytes of text that are cut at a time; a longer text is cut in several steps.
SLICE_BYTES = 2_000_000
#: Units and bytes of units a task remembers before it starts afresh.
KNOWN_UNITS, KNOWN_BYTES = 600_000, 32_000_000

#: A unit: white space, then what follows up to the next white space.
_UNIT = re.compile(rb"[ \t\n\x0b\x0c]*[^ \t\n\x0b\x0c]+|[ \t\n\x0b\x0c]+")
_EDGE = re.compile(rb"[^ \t\n\x0b\x0c](?=[ \t\n\x0b\x0c])")
#: White space beyond that: a text that holds such a character is not cut by ``_UNIT``.
_OTHER_SPACE = re.compile(
    rb"\r|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def plainly_spaced(data: bytes) -> bool:
    return _OTHER_SPACE.search(data) is None


def cut(data: bytes) -> Iterator[list[bytes]]:
    """The units of a text, a slice of it at a time."""
    at = 0
    while at < len(data):
        edge = _EDGE.search(data, at + SLICE_BYTES) if len(data) - at > SLICE_BYTES else None
        end = edge.end() if edge else len(data)
        yield _UNIT.findall(data, at, end)
        at = end


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self._held, self.size = np.zeros(1024, kind), 0

    def add(self, values) -> None:
        end = self.size + len(values)
        if end > len(self._held):
            self._held = np.concatenate([self._held[:self.size], np.zeros(max(end, self.size), self._held.dtype)])
        self._held[self.size:end] = values
        self.size = end

    def all(self) -> np.ndarray:
        return self._held[:self.size]


class _Known(dict):
    """Numbers of units in the order in which they are met; ``new``: those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, unit: bytes) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


class Numbers:
    """Numbers for units. ``learn`` is told the new ones, in the order of their numbers; ``forget``
    is called when the table starts afresh."""

    def __init__(self, learn: Callable[[list[bytes]], None], forget: Callable[[], None]):
        self._learn, self._forget = learn, forget
        self._known, self._bytes = _Known(), 0

    def full(self) -> bool:
        return len(self._known) > KNOWN_UNITS or self._bytes > KNOWN_BYTES

    def clear(self) -> None:
        """Numbers given before are void."""
        self._known, self._bytes = _Known(), 0
        self._forget()

    def make_room(self) -> None:
        """Between texts only: numbers given before it are void if the table was full."""
        if self.full():
            self.clear()

    def of(self, units: list[bytes]) -> np.ndarray:
        numbers = np.fromiter(map(self._known.__getitem__, units), np.int64, len(units))
        if self._known.new:
            new, self._known.new = self._known.new, []
            self._bytes += sum(map(len, new))
            self._learn(new)
        return numbers
