"""Words of many texts at once, as arrays of hashes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0xD1342543DE82EF95)
_SEED = 7
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


@dataclass
class Words:
    """Words (runs of other bytes than blanks and 0x09 to 0x0D) of texts joined by blanks: the
    text each belongs to, where it starts and ends in ``raw``, and a 64-bit hash. ``offsets`` are
    the texts' starts in ``raw``, and ``first`` their first words, with one more at the end."""

    raw: np.ndarray
    offsets: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


class WordSplitter:
    """Splits texts; keeps the tables it needs between calls."""

    def __init__(self):
        self.table = np.random.default_rng(_SEED).integers(0, 1 << 63, 256, dtype=np.uint64)
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def split(self, texts: Sequence[bytes]) -> Words:
        raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        offsets = np.cumsum(sizes) - sizes
        n = len(raw)
        space = SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if n and not space[0]:
            edge = np.r_[0, edge]
        start, end = edge[::2], edge[1::2]
        hashed = np.empty(len(start), dtype=np.uint64)
        # Words of some 1 MB at a time, as their bytes are spread to 64 bits each.
        cuts = np.unique(np.r_[np.searchsorted(start, np.arange(0, n, 1 << 20)), len(start)])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            hashed[a:b] = self._hashes(raw[start[a] : end[b - 1]], start[a:b] - start[a], end[a:b] - start[a])
        first = np.searchsorted(start, np.r_[offsets, n])
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        return Words(raw, offsets, text, start, end, hashed, first)

    def _hashes(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(raw)
        if len(self.up) < n:
            inverse = pow(int(_BASE), -1, 1 << 64)
            self.up, self.down = np.full(n, _BASE), np.full(n, inverse, dtype=np.uint64)
            self.up[:1] = self.down[:1] = 1
            self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.table[raw] * self.up[:n], out=sums[1:])
        return mixed((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``k`` successive words and the text it belongs to; a text of fewer words, but
    one at least, has one of all its words. Texts stay in order."""
    counts = np.diff(words.first)
    n_of = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n_of)
    at = np.arange(len(text)) - np.repeat(np.cumsum(n_of) - n_of, n_of) + words.first[:-1][text]
    stop = words.first[1:][text]
    out = np.zeros(len(text), dtype=np.uint64)
    for j in range(k):
        there = at + j < stop
        part = words.hash[np.minimum(at + j, max(len(words.hash) - 1, 0))] if len(at) else out
        out = out * np.uint64(0x9E3779B97F4A7C15) + np.where(there, part, np.uint64(j + 1))
    return mixed(out), text
