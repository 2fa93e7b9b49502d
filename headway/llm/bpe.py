"""Byte pair merging of many words at once, from a tokenizer file."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np

NEVER = np.iinfo(np.int64).max
# Words of more bytes are left to the tokenizers library, whose merging has a queue.
LONG_WORD = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def byte_names() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable,
    else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, free = [], 256
    for byte in range(256):
        names.append(chr(byte if byte in printable else free))
        free += byte not in printable
    return names


class MergeTable:
    """Merges of a byte-level BPE vocabulary, looked up for arrays of pairs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, names = model["vocab"], byte_names()
        suffix = model.get("end_of_word_suffix") or ""
        self.first = np.array([vocab[name] for name in names], dtype=np.int64)
        self.last = np.array([vocab[name + suffix] for name in names], dtype=np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NEVER, dtype=np.int64)
        keys = (left << 32) | right
        slots = self._slots(keys)
        todo = np.arange(len(keys))
        while len(todo):
            at = slots[todo]
            free = self.keys[at] < 0
            # Of the keys that want one slot, the first gets it; the others try the next.
            _, first = np.unique(np.where(free, at, -1 - todo), return_index=True)
            put = first[free[first]]
            self.keys[at[put]] = keys[todo[put]]
            self.ranks[at[put]] = todo[put]
            left_over = np.ones(len(todo), dtype=bool)
            left_over[put] = False
            todo = todo[left_over]
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NEVER if there is none."""
        keys = (left << 32) | right
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NEVER)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def encode(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's end. No word may be empty.

        In each round every word that still has a merge makes the one of lowest rank, the leftmost
        of equal ones, as merging one at a time does.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        if not len(words):
            return np.empty(0, dtype=np.int64), lengths
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(lengths)
        ids = self.first[raw]
        ids[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(ids), NEVER, dtype=np.int64)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.rank(ids[inner], ids[inner + 1])
        done_word, done_ids = [], []
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            place = np.where(rank == NEVER, NEVER, rank << 32 | np.arange(len(ids)))
            best = np.minimum.reduceat(place, starts)
            open_ = best != NEVER
            if not open_.all():
                sizes = np.diff(np.r_[starts, len(ids)])
                live = np.repeat(open_, sizes)
                done_word.append(word[~live])
                done_ids.append(ids[~live])
                shift = np.cumsum(~live)
                best = best[open_]
                at = best & 0xFFFFFFFF
                at = at - shift[at]
                ids, word, rank = ids[live], word[live], rank[live]
            else:
                at = best & 0xFFFFFFFF
            if not len(ids):
                break
            ids[at] = self.merged[best >> 32]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            ids, word, rank = ids[keep], word[keep], rank[keep]
            for pair in (at - 1, at):
                ok = (pair >= 0) & (pair + 1 < len(ids))
                same = np.zeros(len(pair), dtype=bool)
                same[ok] = word[pair[ok]] == word[pair[ok] + 1]
                inside = pair[same]
                rank[inside] = self.rank(ids[inside], ids[inside + 1])
                rank[pair[ok & ~same]] = NEVER
                rank[pair[(pair >= 0) & ~ok]] = NEVER
        word, ids = np.concatenate(done_word), np.concatenate(done_ids)
        order = np.argsort(word, kind="stable")
        return ids[order], np.cumsum(np.bincount(word, minlength=len(words)))


def id_bytes(ids: np.ndarray) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return ids.astype("<u4").tobytes()
