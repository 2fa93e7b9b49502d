"""Repeated byte strings by bucket-pointer refinement of sampled suffixes.

Every ``depth``-byte window of a text is sorted into buckets by ever longer prefixes. A bucket is
named by its content, so that no round has to hand out ranks: the first name is a hash of ``Q``
bytes, and the name of twice the length is made from the names at a place and at a later offset.

1. Sampling. A window's pointer is the place of its smallest ``Q``-byte name, the leftmost of
   equal ones. Equal windows have equal pointers, wherever they lie. Successive windows with one
   pointer are one run, whose bucket is the name at the pointer; a run holds half of ``depth``
   windows or so. A run alone in its bucket repeats nowhere.
2. Refinement of runs. A run is named by the ``depth``-byte names of its first and last window,
   which cover it. Where two runs of a bucket agree, all their windows repeat: inside copies and
   passages one row stands for hundreds of windows.
3. Refinement of stretches. Where a bucket holds different runs, each different run is cut into
   stretches of ``STRETCH`` windows, counted from the pointer. All windows of a stretch hold its
   core, nearly as long as a window. The core's name is its new bucket, and stretches are named,
   compared and settled as runs were.
4. Refinement of windows. Only where one core has different stretches, at the ends of passages,
   each different stretch lists the names of its windows.

What was settled before counts twice in a later round. Names have 128 bits with their bucket's. All
rounds are joins and counts over rows of a few numbers, pre-aggregated before each shuffle; a
bucket or a text's copies never meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.stage import as_id, discard, id_key, staged

DEPTH = 400
Q = 64
# Windows of a stretch.
STRETCH = 16
# Bytes worked on at a time; a longer text is cut into parts that overlap by a window, which may
# cut a run in two but loses no window.
PART = 1 << 18
_PLACE_BITS = np.uint64(30)
_LANES = (
    (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95), 11),
    (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0xAEF17502108EF2D9), 23),
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Names:
    """Names of the ``Q``-byte strings of a buffer, in two lanes, and of longer strings."""

    def __init__(self, depth: int):
        self.depth, self.powers = depth, {}

    def _tables(self, lane: int, n: int):
        table, up, down = self.powers.get(lane, (None, np.empty(0), None))
        if len(up) < n:
            _, base, seed = _LANES[lane]
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            table = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64)
            up = np.full(n, base, dtype=np.uint64)
            down = np.full(n, inverse, dtype=np.uint64)
            up[0] = down[0] = 1
            self.powers[lane] = table, np.cumprod(up), np.cumprod(down)
        return self.powers[lane]

    def short(self, raw: np.ndarray, lane: int) -> np.ndarray:
        """Names of the strings of ``Q`` bytes that start at each place."""
        n = len(raw)
        table, up, down = self._tables(lane, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[raw] * up[:n], out=sums[1:])
        return _mixed((sums[Q:] - sums[:-Q]) * down[: n - Q + 1])

    def long(self, short: np.ndarray, at: np.ndarray, lane: int) -> np.ndarray:
        """Names of the strings of ``depth`` bytes that start at the given places."""
        return self._name(short, at, self.depth, _LANES[lane][0])

    # No function within ``long``: one that calls itself is a cycle, and would hold the names of a
    # whole buffer until Python looks for such garbage, hundreds of MB in a worker.
    def _name(self, short: np.ndarray, place: np.ndarray, length: int, mix: np.uint64) -> np.ndarray:
        if length == Q:
            return short[place]
        # The longest string half as long or more whose two copies cover this one.
        half = Q
        while 2 * half < length:
            half *= 2
        first = self._name(short, place, half, mix)
        return _mixed(first * mix + self._name(short, place + (length - half), half, mix))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` successive values."""
    n = len(values) - width + 1
    padded = -(-len(values) // width) * width
    blocks = np.full(padded, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def parts(texts: Iterator[tuple], depth: int) -> Iterator[tuple]:
    """Groups of texts as one buffer: keys, first byte of each within its text, starts, ends.
    ``texts`` are (key, bytes); those shorter than a window are left out."""
    keys, froms, pieces, size = [], [], [], 0
    for key, text in texts:
        for start in range(0, len(text) - depth + 1, PART):
            piece = text[start : start + PART + depth - 1]
            keys.append(key)
            froms.append(start)
            pieces.append(piece)
            size += len(piece)
            if size >= PART:
                yield keys, froms, pieces
                keys, froms, pieces, size = [], [], [], 0
    if pieces:
        yield keys, froms, pieces


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


PLACES = "doc_id long, text_key long, low int, high int, pointer int"
RUN_SCHEMA = f"{PLACES}, bucket long, name long"


def _name_of_span(names: Names, short: np.ndarray, low: np.ndarray, high: np.ndarray, lane: int):
    """Names of the bytes from window ``low`` to the end of window ``high``, less than a window
    on."""
    spread = (high - low).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
    mix = _LANES[lane][0]
    return _mixed(names.long(short, low, lane) * mix + names.long(short, high, lane) + spread)


def _run_finder(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(depth)
        low_bits = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)

        def texts():
            for batch in batches:
                columns = [batch.column(c) for c in ("doc_id", "text_key", "content")]
                for doc, key, content in zip(*columns, strict=True):
                    if content.is_valid:
                        yield (doc.as_py(), key.as_py()), content.as_buffer()

        for keys, froms, pieces in parts(texts(), depth):
            raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
            sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
            starts = np.cumsum(sizes) - sizes
            short = names.short(raw, 0)
            ranked = (short & ~low_bits) | np.arange(len(short), dtype=np.uint64)
            pointer = (sliding_min(ranked, depth - Q + 1) & low_bits).astype(np.int64)
            # Window places of each text; windows across two texts are left out.
            n_windows = sizes - depth + 1
            inside = np.zeros(len(raw) + 1, dtype=np.int64)
            np.add.at(inside, starts, 1)
            np.add.at(inside, starts + n_windows, -1)
            inside = np.cumsum(inside[: len(pointer)]) > 0
            new = np.empty(len(pointer), dtype=bool)
            new[0] = True
            new[1:] = pointer[1:] != pointer[:-1]
            new[starts] = True
            low = np.flatnonzero(new & inside)
            # A run ends before the next begins or at its text's last window.
            owner = np.searchsorted(starts, low, side="right") - 1
            last = starts[owner] + n_windows[owner] - 1
            high = np.minimum(np.r_[low[1:] - 1, len(pointer) - 1], last)
            shift = np.array(froms, dtype=np.int64) - starts
            columns = {
                "low": low + shift[owner], "high": high + shift[owner],
                "pointer": pointer[low] + shift[owner],
            }
            # The bucket has the first lane, the name the second.
            name = _name_of_span(names, names.short(raw, 1), low, high, 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": np.array([k[0] for k in keys], dtype=np.int64)[owner],
                    "text_key": np.array([k[1] for k in keys], dtype=np.int64)[owner],
                }
                | {c: v.astype(np.int32) for c, v in columns.items()}
                | {"bucket": _signed(short[pointer[low]]), "name": _signed(name)}
            )

    return run


ASKED = ("low", "high", "pointer", "weight")


def _asked_parts(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple]:
    """Asked spans of windows with the bytes around them, many at a time: a buffer, and arrays of
    doc_id, text_key, low, high, pointer and weight, and of the shift from text to buffer."""
    pieces, rows, size = [], [], 0

    def taken():
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        return raw, *(np.concatenate(c) for c in zip(*rows, strict=True))

    for batch in batches:
        keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
        for doc, key, content, spans in zip(
            *keys, batch.column("content"), batch.column("spans"), strict=True
        ):
            content = content.as_buffer()
            spans = [spans.values.field(c).to_numpy().astype(np.int64) for c in ASKED]
            # Spans of one part of the text at a time.
            part = spans[0] // PART
            for number in np.unique(part).tolist():
                low, high, pointer, weight = (x[part == number] for x in spans)
                first, end = int(low.min()), int(high.max()) + depth
                n = len(low)
                pieces.append(content[first:end])
                rows.append((
                    np.full(n, doc, dtype=np.int64), np.full(n, key, dtype=np.int64),
                    low, high, pointer, weight, np.full(n, size - first),
                ))
                size += end - first
                if size >= PART:
                    yield taken()
                    pieces, rows, size = [], [], 0
    if pieces:
        yield taken()


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` so many rows: the number it is of, and 0, 1, 2 ... within it."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


STRETCH_SCHEMA = f"{PLACES}, weight int, bucket long, name long"


def _stretch_cutter(depth: int):
    core = depth - STRETCH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, cores = Names(depth), Names(core)
        for raw, doc, key, low, high, pointer, weight, shift in _asked_parts(batches, depth):
            # Stretches by their distance from the pointer, the nearest first.
            nearest, farthest = (pointer - high) // STRETCH, (pointer - low) // STRETCH
            of, number = _spread(farthest - nearest + 1)
            number = number + nearest[of]
            a = np.maximum(low[of], pointer[of] - (number + 1) * STRETCH + 1)
            b = np.minimum(high[of], pointer[of] - number * STRETCH)
            # Every window of the stretch holds the bytes from its last place on.
            at = pointer[of] - number * STRETCH
            short = [names.short(raw, lane) for lane in (0, 1)]
            moved = shift[of]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": doc[of], "text_key": key[of], "low": a.astype(np.int32),
                    "high": b.astype(np.int32), "pointer": pointer[of].astype(np.int32),
                    "weight": weight[of].astype(np.int32),
                    "bucket": _signed(cores.long(short[0], at + moved, 0)),
                    "name": _signed(_name_of_span(names, short[1], a + moved, b + moved, 1)),
                }
            )

    return run


WINDOW_SCHEMA = "doc_id long, text_key long, place int, weight int, name_a long, name_b long"


def _window_lister(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(depth)
        for raw, doc, key, low, high, _, weight, shift in _asked_parts(batches, depth):
            of, number = _spread(high - low + 1)
            place = low[of] + number
            ids = [names.long(names.short(raw, k), place + shift[of], k) for k in (0, 1)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": doc[of], "text_key": key[of], "place": place.astype(np.int32),
                    "weight": weight[of].astype(np.int32),
                    "name_a": _signed(ids[0]), "name_b": _signed(ids[1]),
                }
            )

    return run


def _refined(spans: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame]:
    """One round over staged spans with bucket, name and weight: those that agree with another
    one, and the texts' lists of different spans whose bucket holds several, one of them alone so
    far. Uses the spans up."""
    name = ["bucket", "name"]
    # Most are alone in their bucket and go at once.
    several = spans.groupBy("bucket").count().where("count > 1").select("bucket")
    shared = staged(spans.join(several, "bucket", "left_semi"), f"{purpose}-shared")
    discard(spans)
    kinds = staged(
        shared.groupBy(*name).agg(
            F.sum("weight").alias("weight"),
            F.min(F.struct("doc_id", "text_key", "low", "high", "pointer")).alias("first"),
        ).withColumn("weight", F.least("weight", F.lit(2)).cast("int")),
        f"{purpose}-kinds",
    )
    settled = staged(
        shared.where("weight = 1").join(kinds.where("weight > 1").select(*name), name, "left_semi")
        .select("doc_id", "text_key", "low", "high"),
        f"{purpose}-settled",
    )
    discard(shared)
    mixed = kinds.groupBy("bucket").agg(
        F.count("*").alias("kinds"), F.min("weight").alias("least")
    ).where("kinds > 1 AND least = 1").select("bucket")
    asked = staged(
        kinds.join(mixed, "bucket", "left_semi").select("first.*", "weight")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct(*ASKED)).alias("spans")),
        f"{purpose}-asked",
    )
    discard(kinds)
    return settled, asked


def _rounds(contents: DataFrame, depth: int) -> list[DataFrame]:
    """What each round settled, as staged tables."""
    if depth < Q + STRETCH - 1:
        raise ValueError(f"strings must be {Q + STRETCH - 1} bytes long at least")
    key = ["doc_id", "text_key"]
    runs = contents.mapInArrow(_run_finder(depth), RUN_SCHEMA).withColumn("weight", F.lit(1))
    whole, asked = _refined(staged(runs, "runs"), "runs")
    # A text that is there twice under one id is cut twice here; all of it is settled, and what
    # is settled counts as repeated anyway. What is asked for grows with the corpus, so texts are
    # shuffled to it at any size.
    stretches = staged(
        contents.join(asked.hint("merge"), key).mapInArrow(_stretch_cutter(depth), STRETCH_SCHEMA),
        "stretches",
    )
    discard(asked)
    partly, asked = _refined(stretches, "stretches")
    windows = staged(
        contents.join(asked.hint("merge"), key).mapInArrow(_window_lister(depth), WINDOW_SCHEMA),
        "windows",
    )
    discard(asked)
    again = (
        windows.groupBy("name_a", "name_b").agg(F.sum("weight").alias("weight"))
        .where("weight > 1").select("name_a", "name_b")
    )
    single = staged(
        windows.where("weight = 1").join(again, ["name_a", "name_b"], "left_semi").select(
            *key, F.col("place").alias("low"), F.col("place").alias("high")
        ),
        "single",
    )
    discard(windows)
    return [whole, partly, single]


def _together(rounds: list[DataFrame]) -> DataFrame:
    return rounds[0].unionAll(rounds[1]).unionAll(rounds[2])


def repeated_spans(contents: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Windows that repeat, for rows of doc_id, text_key and content (binary): doc_id, text_key,
    low, high; the windows that start from low to high all start elsewhere too."""
    return _together(_rounds(contents, depth))


def cut_out(content: bytes, low: np.ndarray, high: np.ndarray, depth: int):
    """What is left of a text without the given windows, bytes removed, and runs removed."""
    order = np.argsort(low, kind="stable")
    start, end = low[order], np.maximum.accumulate(high[order] + depth)
    new = np.r_[True, start[1:] > end[:-1]]
    start, end = start[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]
    kept, at = [], 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        kept.append(content[at:a])
        at = b
    kept.append(content[at:])
    return b"".join(kept), int((end - start).sum()), len(start)


def _contents(docs: DataFrame) -> DataFrame:
    return docs.select(
        id_key().alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.coalesce("text", F.lit("")).cast("binary").alias("content"),
    )


def _listed(spans: DataFrame) -> DataFrame:
    """Spans of each text, as many as its length allows at most."""
    return spans.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("low", "high")).alias("spans")
    )


def remove_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """All rows of ``docs`` (doc_id and text, other columns are left out) as doc_id, n_bytes,
    n_removed, n_spans and kept, the UTF-8 bytes that no repeated window covers.

    A null text is empty; texts shorter than a window stay; a repeated row is a copy like any
    other, and loses all its bytes if it has a window.
    """
    contents = _contents(docs)
    rounds = _rounds(contents, depth)
    spans = _listed(_together(rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, content, own in zip(
                batch.column("doc_id").to_pylist(), batch.column("content"),
                batch.column("spans"), strict=True,
            ):
                content = content.as_py()
                if own.is_valid and len(own):
                    low, high = own.values.flatten()
                    kept, removed, n = cut_out(content, low.to_numpy(), high.to_numpy(), depth)
                    rows.append((doc, len(content), removed, n, kept))
                else:
                    rows.append((doc, len(content), 0, 0, content))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    cut = contents.join(spans.hint("merge"), ["doc_id", "text_key"], "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    # Written here, as its caller would hand texts to Python in batches of Spark's own size.
    kept = staged(cut, "kept")
    discard(*rounds)
    return kept.withColumn("doc_id", as_id("doc_id"))


def strip_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``docs`` without the repeated bytes in ``text``; a character of which a part goes, goes
    whole. Other columns stay, a null text stays null."""
    place = docs.columns.index("text")
    columns = [f"c{i}" for i in range(len(docs.columns))]
    # Positions stand for the columns' names, which may be those of the spans.
    named = docs.toDF(*columns)
    spans = _listed(repeated_spans(_contents(docs), depth))
    same = (id_key(columns[docs.columns.index("doc_id")]) == spans["doc_id"]) & (
        F.xxhash64(columns[place]) == spans["text_key"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for number, own in enumerate(batch.column("spans")):
                if own.is_valid and len(own):
                    low, high = own.values.flatten()
                    left = cut_out(texts[number].encode(), low.to_numpy(), high.to_numpy(), depth)[0]
                    texts[number] = left.decode("utf-8", "ignore")
            arrays = list(batch.columns[:-1])
            arrays[place] = pa.array(texts, arrays[place].type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    joined = named.join(spans.hint("merge"), same, "left").select(*columns, "spans")
    return joined.mapInArrow(run, named.schema).toDF(*docs.columns)
