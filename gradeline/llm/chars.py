"""Texts as arrays of code points: words, their hashes and other stretches, a batch at a time.

Most words of a large corpus are rare, so remembering them does not pay; everything here is
computed for all characters of a batch together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np

from gradeline.llm.common import FIRST_BASE, Rolling, mixed

CHUNK_CHARS = 1 << 20
_TABLE = 1 << 16


@cache
def class_table(is_member: Callable[[str], bool]) -> np.ndarray:
    """Membership of each code point below 2**16, and at the end that of all above."""
    low = [is_member(chr(i)) for i in range(_TABLE)]
    return np.array([*low, is_member("\U00020000")])


def is_blank(char: str) -> bool:
    return char in " \t\n\v\f\r"


def is_space(char: str) -> bool:
    return char.isspace()


def is_not_word(char: str) -> bool:
    return not (char.isalnum() or char == "_")


def lowered(text: str) -> str:
    """Lower case of the same length; characters that would become several stay."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def chunks(texts: Sequence[str], chars: int = CHUNK_CHARS) -> Iterator[slice]:
    """Consecutive texts of about so many characters together; a longer text is alone."""
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > chars:
            yield slice(start, i)
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


class Points:
    """Code points of some texts, one after another with a line feed after each."""

    def __init__(self, texts: Sequence[str]):
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.edges = np.r_[0, np.cumsum(sizes)]
        joined = "".join([text + "\n" for text in texts])
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.low = np.minimum(self.points, _TABLE).astype(np.int64)

    def where(self, is_member: Callable[[str], bool]) -> np.ndarray:
        return class_table(is_member)[self.low]


def spans(outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``outside`` does not hold."""
    edges = np.flatnonzero(np.diff(np.r_[True, outside, True].astype(np.int8)))
    return edges[::2], edges[1::2]


class Words:
    """Words of some texts: character spans, hashes, and the range of words of each text."""

    def __init__(self, texts: Sequence[str], separates: Callable[[str], bool], rolling: Rolling | None = None):
        self.points = Points(texts)
        self.starts, self.ends = spans(self.points.where(separates))
        self.edges = np.searchsorted(self.starts, self.points.edges)
        self.rolling = rolling or Rolling(FIRST_BASE)
        self.prefix = self.rolling.prefix(mixed(self.points.points))
        self.hashes = self.rolling.stretches(self.prefix, self.starts, self.ends)

    @property
    def text_of(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))

    def beginnings(self, chars: int) -> np.ndarray:
        """Hashes of the first characters of each word, of the whole word if it is shorter."""
        return self.rolling.stretches(self.prefix, self.starts, np.minimum(self.ends, self.starts + chars))


def grams(hashes: np.ndarray, edges: np.ndarray, n: int, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within one text, and the index of the first word of each."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    last = np.repeat(edges[1:], np.diff(edges))
    first = np.arange(len(hashes))
    first = first[first + n <= last]
    return rolling.stretches(rolling.prefix(hashes), first, first + n), first
