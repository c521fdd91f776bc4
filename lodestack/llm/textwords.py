"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes outside the blank and U+0009 to U+000D.  Hashes are 64
bits wide and the same on every machine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .common import BLANKS

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Bytes of words that are hashed together.
_SEGMENT = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(bits: int, inverse: bool) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full((1 << bits) - 1, _R_INVERSE if inverse else _R))])


class Words:
    """start, end: byte ranges in ``data``; counts: words of each text; hash: of each word with A-Z lower-cased."""

    def __init__(self, texts: list[str | None]):
        raw = b"\n".join((t or "").encode() for t in texts) + b"\n"
        self.data = np.frombuffer(raw, np.uint8)
        blank = _IS_BLANK[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
        self.start, self.end = edge[::2], edge[1::2]
        sizes = np.array([len((t or "").encode()) + 1 for t in texts], np.int64)
        bounds = np.searchsorted(self.start, np.concatenate([[0], np.cumsum(sizes)]))
        self.counts = np.diff(bounds)
        self.hash = np.zeros(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):  # in segments that fit a processor's cache; a word's hash doesn't depend on its place
            base = self.start[at]
            stop = max(at + 1, int(np.searchsorted(self.end, base + _SEGMENT, "right")))
            low = _LOWER[self.data[base : self.end[stop - 1]]].astype(np.uint64) + np.uint64(1)
            bits = max(17, len(low).bit_length())
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low * _powers(bits, False)[: len(low)])])
            first, last = self.start[at:stop] - base, self.end[at:stop] - base
            self.hash[at:stop] = mix((upto[last] - upto[first]) * _powers(bits, True)[first] + (last - first).astype(np.uint64))
            at = stop


def shingles(words: Words, size: int = 5) -> list[np.ndarray]:
    """Each text's set of hashed shingles, sorted.

    A shingle is ``size`` words in a row; a text with fewer words has the whole
    sequence as its one shingle, a text without words none.
    """
    h = words.hash
    n = max(0, len(h) - size + 1)
    all_of = np.zeros(n, np.uint64)
    factor = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
    for k in range(size):
        all_of += h[k : n + k] * factor[k % 5] ** np.uint64(1 + k // 5)
    all_of = mix(all_of + np.uint64(size))
    out, at = [], 0
    for c in words.counts.tolist():
        if c >= size:
            out.append(np.unique(all_of[at : at + c - size + 1]))
        elif c:
            part = h[at : at + c]
            out.append(mix(np.array([sum(int(x) * int(f) for x, f in zip(part, factor, strict=False)) + c & (1 << 64) - 1], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out
