"""A lexicon of words with id outputs, as a minimal acyclic transducer.

Words that end alike share their final states, so the automaton is the smallest that accepts just
these words. Each arc carries a number; the numbers along a word's path add up to its place among
the sorted words, and that place leads to its ids. Arcs are kept sorted by state and byte in one
array, which a worker memory-maps and searches for many words at once.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Lexicon:
    """``arcs``: state << 8 | byte, sorted; ``target`` and ``output`` of each; ``final`` by state;
    ``ends``: where the ids of each word end in ``ids``."""

    arcs: np.ndarray
    target: np.ndarray
    output: np.ndarray
    final: np.ndarray
    ends: np.ndarray
    ids: np.ndarray

    FIELDS = ("arcs", "target", "output", "final", "ends", "ids")

    def lookup(self, words: Sequence[bytes]) -> np.ndarray:
        """Place of each word in the lexicon, -1 if it is not there."""
        place = np.full(len(words), -1, dtype=np.int64)
        if not len(words) or not len(self.arcs):
            return place
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.cumsum(lengths) - lengths
        state = np.zeros(len(words), dtype=np.int64)
        total = np.zeros(len(words), dtype=np.int64)
        alive = np.arange(len(words))
        step = 0
        while len(alive):
            at_end = lengths[alive] == step
            ended = alive[at_end]
            good = ended[self.final[state[ended]] > 0]
            place[good] = total[good]
            alive = alive[~at_end]
            key = state[alive] << 8 | raw[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[arc] == key
            alive, arc = alive[hit], arc[hit]
            state[alive] = self.target[arc]
            total[alive] += self.output[arc]
            step += 1
        return place

    def ids_of(self, place: int) -> bytes:
        start = self.ends[place - 1] if place else 0
        return self.ids[start : self.ends[place]].tobytes()

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, f), dtype="<i8") for f in self.FIELDS[:-1]]
        parts.append(np.ascontiguousarray(self.ids, dtype="<u4"))
        head = np.array([len(p) for p in parts], dtype="<i8")
        return b"".join([head.tobytes(), *(p.tobytes() for p in parts)])

    @classmethod
    def mapped(cls, content: bytes) -> Lexicon:
        """The lexicon in a memory-mapped file of this worker, unlinked at once, so that it goes
        with the worker. The arrays are views of the map."""
        handle, path = tempfile.mkstemp(prefix="lexicon-")
        with os.fdopen(handle, "w+b") as file:
            file.write(content)
            file.flush()
            view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        os.unlink(path)
        n = len(cls.FIELDS)
        sizes, at, arrays = np.frombuffer(view, "<i8", n), n * 8, []
        for size, kind in zip(sizes.tolist(), ["<i8"] * (n - 1) + ["<u4"], strict=True):
            arrays.append(np.frombuffer(view, kind, size, at))
            at += arrays[-1].nbytes
        return cls(*arrays)


def compile_lexicon(words: dict[bytes, np.ndarray]) -> Lexicon:
    """Builds the automaton of the words, none of them empty, with their ids.

    Words are added in order; when the next one leaves a branch, the branch's states are replaced
    from the end by states already there with the same arcs and finality.
    """
    ordered = sorted(words)
    # A state is [final, {byte: state}]; a register holds one state of each kind, with its number.
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [[False, {}]]
    before = b""

    def settle(state: list) -> int:
        shape = (state[0], tuple(state[1].items()))
        if shape not in register:
            register[shape] = len(states)
            states.append(shape)
        return register[shape]

    def close(down_to: int) -> None:
        while len(path) - 1 > down_to:
            done = path.pop()
            path[-1][1][before[len(path) - 1]] = settle(done)

    for word in ordered:
        common = len(os.path.commonprefix([before, word]))
        close(common)
        path.extend([False, {}] for _ in word[common:])
        path[-1][0] = True
        before = word
    close(0)
    root = settle(path[0])

    # Targets were settled before the states that lead to them, so one pass counts the words.
    count = np.zeros(len(states), dtype=np.int64)
    arcs, target, output = [], [], []
    # The root is numbered 0.
    number = {root: 0, 0: root} if root else {}
    named = [number.get(s, s) for s in range(len(states))]
    for state, (final, out) in enumerate(states):
        passed = int(final)
        for byte, to in out:
            arcs.append(named[state] << 8 | byte)
            target.append(named[to])
            output.append(passed)
            passed += int(count[to])
        count[state] = passed
    order = np.argsort(np.array(arcs, dtype=np.int64), kind="stable")
    final = np.zeros(len(states), dtype=np.int64)
    final[named] = [f for f, _ in states]
    ids = [np.asarray(words[w], dtype=np.uint32) for w in ordered]
    return Lexicon(
        np.array(arcs, dtype=np.int64)[order],
        np.array(target, dtype=np.int64)[order],
        np.array(output, dtype=np.int64)[order],
        final,
        np.cumsum([len(i) for i in ids], dtype=np.int64),
        np.concatenate(ids) if ids else np.empty(0, dtype=np.uint32),
    )
