"""Character n-grams of many texts at once, as arrays."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np

# Characters of texts turned into arrays at a time.
RUN = 1_000_000
_CUT = re.compile("[ \t\r\n]")


@functools.cache
def _class(name: str) -> np.ndarray:
    """For every code point whether ``str.isalnum`` or the like holds."""
    return np.fromiter((getattr(chr(c), name)() for c in range(0x110000)), bool, 0x110000)


def runs(texts: list[str | None], rows: int, longest: int = RUN
         ) -> Iterator[tuple[list[str], list[int]]]:
    """Lower-cased texts and the numbers of their rows, in lists of at most ``rows`` entries and
    about ``RUN`` characters; texts over ``longest`` are cut, before white space, into several."""
    parts: list[str] = []
    owners: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        text, start = (text or "").lower(), 0
        while start < len(text):
            cut = _CUT.search(text, start + longest) if len(text) - start > longest else None
            end = cut.start() if cut else len(text)
            parts.append(text[start:end])
            owners.append(number)
            size += end - start
            start = end
            if size >= RUN or len(parts) >= rows:
                yield parts, owners
                parts, owners, size = [], [], 0
    if parts:
        yield parts, owners


def characters(parts: list[str], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the parts' words, 0 before and after each word, and each one's part."""
    codes = np.frombuffer("\n".join(["", *parts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    # Each part follows a separator of its own; of neighbouring ones the last is kept, so that
    # the start of a word belongs to the part of the word.
    owner = np.repeat(np.arange(len(parts)), [len(p) + 1 for p in parts])
    owner = np.append(owner, len(parts) - 1)
    codes = np.where(_class(kind)[codes], codes, 0)
    kept = np.ones(len(codes), bool)
    kept[:-1] = (codes[:-1] != 0) | (codes[1:] != 0)
    return codes[kept], owner[kept]


def within_words(codes: np.ndarray, size: int) -> np.ndarray:
    """Starts of the runs of ``size`` characters that have a 0 at most first or last."""
    last = len(codes) - size + 1
    if last <= 0:
        return np.zeros(0, np.int64)
    inside = np.ones(last, bool)
    for k in range(1, size - 1):
        inside &= codes[k:k + last] != 0
    if size == 1:
        inside &= codes != 0
    if size == 2:
        inside &= (codes[:last] != 0) | (codes[1:] != 0)
    return np.flatnonzero(inside)
