"""Best-fit packing of documents into sequences, mended by swaps.

A text becomes its token ids and one end id. Only a document longer than a sequence is cut, into
whole sequences and a rest. A full piece is a sequence. Shorter pieces are dealt at random into
groups of bounded size; a group is packed best-fit, longest first, and then mended by local
search: pieces move from the emptiest sequence to others alone, one for one, two for one or one
for two, each step raising the sum of squared fills, until sequences come empty or no step is left.
What lies in sequences that stay underfull is dealt anew into fewer groups and packed again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.stage import slices, staged
from headway.llm.tokens import WordEncoder

SEQUENCE = 4096
END_ID = 1
# Pieces packed in one task.
GROUP_PIECES = 8192
# A sequence with at least this share of its places taken is closed; others are packed again.
CLOSED = 0.995

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def pieces(docs: DataFrame, tokenizer: str, length: int = SEQUENCE) -> DataFrame:
    """Token pieces of ``doc_id``, ``text``: doc_id, piece, start, length and ids, the ids as
    little-endian unsigned 32-bit integers. A null or empty text is its end id alone. Rows are
    taken as they are, a repeated document twice."""
    wide = length * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in slices(batches, "text"):
            rows = []
            texts = encoder.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids += end
                for number, at in enumerate(range(0, len(ids), wide)):
                    piece = ids[at : at + wide]
                    rows.append((doc_id, number, at // 4, len(piece) // 4, piece))
            columns = list(zip(*rows, strict=True)) or [[]] * len(PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, PIECES, strict=True)], schema=PIECES
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary"
    )


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Bin of each item, longest first into the fullest bin it fits, and the number of bins."""
    gaps: list[list[int]] = [[] for _ in range(size + 1)]
    present = np.zeros(size + 1, dtype=bool)
    bins = np.empty(len(lengths), dtype=np.int64)
    n = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        gap = length + int(present[length:].argmax())
        if present[gap]:
            bin_ = gaps[gap].pop()
            present[gap] = bool(gaps[gap])
        else:
            gap, bin_, n = size, n, n + 1
        bins[item] = bin_
        gaps[gap - length].append(bin_)
        present[gap - length] = True
    return bins, n


class SwapSearch:
    """Local search over one group's bins.

    A step gives ``d`` > 0 places from the emptiest bin to one at least as full with room for
    them; that raises the sum of squared fills, an integer with a bound, so the search ends.
    """

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, n: int, size: int):
        self.lengths, self.bins, self.size = lengths, bins.copy(), size
        self.fill = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
        self.least = math.ceil(int(lengths.sum()) / size)

    def used(self) -> int:
        return int((self.fill > 0).sum())

    def run(self) -> np.ndarray:
        """Bins after the search: sweeps from the emptiest bin on, each giving what it can, until
        a sweep empties none or the total length allows no bin fewer."""
        before = self.used() + 1
        while self.least < self.used() < before:
            before = self.used()
            open_ = np.flatnonzero((self.fill > 0) & (self.fill < self.size))
            for source in open_[np.argsort(self.fill[open_], kind="stable")].tolist():
                while self.fill[source] and self.step(source):
                    pass
                if self.used() == self.least:
                    break
        return self.bins

    def step(self, source: int) -> bool:
        """The step out of ``source`` that gives most, if there is one."""
        own = np.flatnonzero(self.bins == source)
        room = np.where(self.fill >= self.fill[source], self.size - self.fill, 0)
        room[source] = 0
        room[self.fill == 0] = 0
        others = np.flatnonzero(room[self.bins] > 0)
        if not len(others):
            return False
        # Give one, or two, and take nothing, or one; of pieces of equal length any will do.
        kinds: dict[int, list[int]] = {}
        for item in own.tolist():
            kinds.setdefault(int(self.lengths[item]), []).append(item)
        gives = {length: (items[0],) for length, items in kinds.items()}
        for length, items in kinds.items():
            if len(items) > 1:
                gives.setdefault(2 * length, (items[0], items[1]))
            for other, others_ in kinds.items():
                if other > length:
                    gives.setdefault(length + other, (items[0], others_[0]))
        best, move = 0, None
        to = self.bins[others]
        widest = int(room.max())
        for amount in sorted(gives, reverse=True):
            items = gives[amount]
            if amount <= best:
                break
            if best < amount <= widest:
                fits = np.where(room >= amount, room, self.size + 1)
                best, move = amount, (items, (), int(fits.argmin()))
            gain = amount - self.lengths[others]
            gain = np.where(gain <= room[to], gain, 0)
            at = int(gain.argmax())
            if gain[at] > best:
                best, move = int(gain[at]), (items, (others[at],), int(to[at]))
        # Give one, take two of one bin: neighbours in order of length, so that each partner is
        # tried with the longest and the shortest of its bin.
        order = np.lexsort((self.lengths[others], to))
        a, b = others[order[:-1]], others[order[1:]]
        same = self.bins[a] == self.bins[b]
        a, b = a[same], b[same]
        if len(a):
            both = self.lengths[a] + self.lengths[b]
            for amount, (item, *_) in kinds.items():
                gain = amount - both
                gain = np.where(gain <= room[self.bins[a]], gain, 0)
                at = int(gain.argmax())
                if gain[at] > best:
                    best, move = int(gain[at]), ((item,), (a[at], b[at]), int(self.bins[a[at]]))
        if move is None:
            return False
        items, back, target = move
        self.bins[list(items)] = target
        if back:
            self.bins[list(back)] = source
        self.fill[source] -= best
        self.fill[target] += best
        return True


def pack_group(lengths: np.ndarray, size: int) -> np.ndarray:
    """Bin of each item of one group, numbered from 0."""
    bins, n = best_fit(lengths, size)
    return np.unique(SwapSearch(lengths, bins, n, size).run(), return_inverse=True)[1]


def _packer(size: int, last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "item"], ascending=[False, True])
        lengths = group["length"].to_numpy()
        bins = pack_group(lengths, size)
        fill = np.bincount(bins, weights=lengths)
        before = pd.Series(lengths).groupby(bins).cumsum().to_numpy() - lengths
        done = np.ones(len(bins), dtype=bool) if last else fill[bins] >= CLOSED * size
        return pd.DataFrame(
            {
                "item": group["item"].to_numpy(),
                "length": lengths,
                "bin": np.where(done, bins, -1),
                "offset": np.where(done, before, 0),
                "group": group["group"].to_numpy(),
            }
        )

    return run


def pack(items: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Places items (``item``, a unique long, and ``length``, 1 to ``size``) in sequences: item,
    sequence_id, offset. A full item has a sequence of its own. No rows give no rows."""
    alone = items.where(F.col("length") == size).select(
        "item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    out, todo, round_ = [alone], items.where(F.col("length") < size).select("item", "length"), 0
    n = todo.count()
    while n:
        groups = math.ceil(n / GROUP_PIECES)
        dealt = todo.withColumn(
            "group", F.pmod(F.xxhash64("item", F.lit(round_)), F.lit(groups))
        )
        # A round that closes little has found hard lengths; dealing them anew won't help.
        last = groups == 1 or round_ == 3
        packed = staged(
            dealt.groupBy("group").applyInPandas(
                _packer(size, last),
                "item long, length long, bin long, offset long, group long",
            ),
            f"pack-round{round_}",
        )
        numbered = F.col("bin") * F.lit(4 * groups) + F.col("group") * 4 + F.lit(round_)
        out.append(
            packed.where("bin >= 0").select("item", numbered.alias("sequence_id"), "offset")
        )
        todo = packed.where("bin < 0").select("item", "length")
        round_ += 1
        n = 0 if last else todo.count()
    result = out[0]
    for part in out[1:]:
        result = result.unionAll(part)
    return result


def packed_pieces(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Pieces (any columns, a ``length`` among them) with sequence_id and offset."""
    clash = {"item", "sequence_id", "offset"} & set(pieces.columns)
    if clash:
        raise ValueError(f"pieces must not have columns {sorted(clash)}")
    # Numbered when written, so that a task run again finds the same numbers.
    numbered = staged(
        pieces.withColumn("item", F.monotonically_increasing_id()), "pieces"
    )
    return numbered.join(pack(numbered, size), "item").drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length and ids, the pieces' ids in order of offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(
            parts, F.lit(b""), lambda joined, part: F.concat(joined, part["ids"])
        ).alias("ids"),
    )
