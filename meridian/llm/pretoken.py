"""Splits text into the matches of the byte-level BPE pattern with array operations.

The pattern is: English contractions, then letters, numbers or other signs with one space before them at most,
then white space. A text's characters are classed by a table; a piece starts where the class changes, and the two
rules that look further (the last blank of a run joins what follows, contractions) move single starts.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import regex

LETTER, NUMBER, SPACE = 1, 2, 3


@functools.cache
def classes() -> np.ndarray:
    """Of every code point: 1 letter, 2 number, 3 white space, 0 other."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            out[a : b + 1] = kind
    out[0xD800:0xE000] = 0
    return out


def starts(text: str) -> np.ndarray:
    """Where the pieces of a non-empty text start."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kind = classes()[points]
    first = np.empty(len(points), bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:])
    first[last] = True
    first[last[points[last] == 32] + 1] = False
    quotes = np.flatnonzero((points[:-1] == 39) & first[:-1] & (kind[1:] == LETTER))
    for p in quotes.tolist():
        two = text[p + 1 : p + 3]
        size = 2 if two[0] in "stmd" else 3 if two in ("re", "ve", "ll") else 0
        if size:
            first[p + 1] = False
            if p + size < len(points):
                first[p + size] = True
    return np.flatnonzero(first)


def split(text: str) -> list[str]:
    if not text:
        return []
    at = starts(text).tolist()
    at.append(len(text))
    return [text[a:b] for a, b in zip(at, at[1:])]


_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: Characters of a text from which on its words are told apart as strings: hashing would need tables as long.
LONG = 1 << 20


@functools.cache
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    inverse = pow(base, -1, 1 << 64)
    one = np.ones(1, np.uint64)
    return tuple(np.concatenate([one, np.cumprod(np.full(size, x, np.uint64))]) for x in (base, inverse))


def _hashes(points: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    power, inverse = _powers(which, 1 << max(14, len(points).bit_length()))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint32(1)) * power[: len(points)], out=sums[1:])
    return (sums[end] - sums[begin]) * inverse[begin]


def distinct(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pieces of all texts in order of appearance, every piece as its number there, and pieces of each text.

    Pieces are told apart by one hash and held against a second one; should they disagree, or a text be very long, the
    pieces themselves decide.
    """
    if any(len(t) >= LONG for t in texts):
        return _by_strings(texts)
    begins, ends, ones, twos = [], [], [], []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if not text:
            continue
        begin = starts(text)
        end = np.append(begin[1:], len(text))
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        begins.append(begin.astype(np.int32))
        ends.append(end.astype(np.int32))
        ones.append(_hashes(points, begin, end, 0))
        twos.append(_hashes(points, begin, end, 1))
        counts[i] = len(begin)
    if not begins:
        return [], np.zeros(0, np.uint32), counts
    numbers = pa.array(np.concatenate(ones)).dictionary_encode().indices.to_numpy()
    del ones
    two = np.concatenate(twos)
    del twos
    top = np.maximum.accumulate(numbers)
    first = np.flatnonzero(numbers > np.concatenate([[-1], top[:-1]]))
    if not np.array_equal(two[first][numbers], two):
        return _by_strings(texts)
    begin, end = np.concatenate(begins)[first], np.concatenate(ends)[first]
    owner = np.searchsorted(np.cumsum(counts), first, side="right")
    words = [texts[d][a:b] for d, a, b in zip(owner.tolist(), begin.tolist(), end.tolist())]
    return words, numbers.astype(np.uint32), counts


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _by_strings(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    known, flat, counts = _Numbers(), [], []
    for text in texts:
        pieces = split(text)
        flat.append(np.fromiter(map(known.__getitem__, pieces), np.uint32, len(pieces)))
        counts.append(len(pieces))
    return list(known), np.concatenate(flat) if flat else np.zeros(0, np.uint32), np.array(counts, np.int64)
