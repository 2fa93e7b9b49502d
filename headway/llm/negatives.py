"""Hard negatives: exact top lists by inner product, over candidate lists that anchor clusters share.

Anchors, a bounded block of them at a time, are clustered by direction. A task takes its rows in
chunks; for each cluster it sorts a chunk once by the greatest inner product that a member of unit
length can have with the row: the row's length times the cosine of its angle to the centre, less the
widest angle of a member to the centre. Every member walks that one list from the top, until the
bound of what is left times its own length is below what it still needs; then its list is certified.
What a member needs rises from chunk to chunk, and starts from what a sixteenth of the rows, walked
before, has shown to be there, so that tasks return little more than the result. Two walks are made:
for positives among rows of the anchor's label, and for negatives among the others, in
the range of scores that each positive allows.

Scores are integers and exact: products are summed as floats only where these hold all the digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.stage import discard, staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# A negative's score as a percentage of the positive's.
LOWEST, HIGHEST = 50, 95
# Anchors walked together, which are broadcast, and rows and bytes of a chunk.
BLOCK_ANCHORS = 1 << 16
BLOCK_BYTES = 64 << 20
CHUNK_ROWS = 1 << 14
CHUNK_BYTES = 16 << 20
# Rows that are walked first: one in so many.
SAMPLE = 16
CLUSTERS = 64
ROUNDS = 8
# Rows of a list scored at a time, at first and at most, and members that walk together.
STRIDE, LONGEST_STRIDE = 256, 4096
MEMBERS = 512
# Lengths of scaled vectors stay below this, so that no score passes 64 bits.
LONGEST = float(1 << 31)
NOTHING = -(1 << 62)
# Angles are widened by this, above the error of an arc cosine of doubles.
WIDER = 1e-6


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[] for _ in _ROWS]
        columns = [batch.column(n).to_pylist() for n in ("row", "vec_id", "label", "anchor")]
        for *known, vector in zip(*columns, batch.column("vector"), strict=True):
            vector = vector.values
            if known[2] is None or vector is None or vector.null_count:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(SCALE * vector.to_numpy(zero_copy_only=False).astype(np.float64))
                ok = np.isfinite(x).all() and math.sqrt(float(x @ x)) < LONGEST
            if ok:
                row = *known, len(x), x.astype(np.int32).tobytes()
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, _ROWS.types, strict=True)], schema=_ROWS
        )


_ROWS = pa.schema([
    ("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("anchor", pa.bool_()),
    ("dims", pa.int32()), ("scaled", pa.binary()),
])
_ROWS_SQL = "row long, vec_id long, label long, anchor boolean, dims int, scaled binary"


def _matrix(scaled: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(scaled), dtype=np.int32).reshape(len(scaled), dims).astype(np.int64)


def _lengths(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.sqrt((x * x).sum(axis=1))


def _units(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return x / np.where(lengths > 0, lengths, 1)[:, None]


def clusters_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spherical k-means: centres, the cluster of each row, and the widest angle in each cluster.
    Rows of length 0 have score 0 with all, so any cluster bounds them."""
    lengths = _lengths(x)
    units = _units(x, lengths)
    k = int(min(CLUSTERS, max(1, math.isqrt(len(x)) // 2)))
    random = np.random.default_rng(len(x))
    centres = units[random.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], centres)
    cosines = units @ centres.T
    own = cosines.argmax(axis=1)
    angles = np.arccos(np.clip(cosines[np.arange(len(x)), own], -1, 1)) * (lengths > 0)
    widest = np.zeros(k)
    np.maximum.at(widest, own, angles)
    return centres, own, widest


def bounds(unit: np.ndarray, lengths: np.ndarray, centre: np.ndarray, widest: float) -> np.ndarray:
    """For each row, no less than its inner product with any member of unit length."""
    angle = np.arccos(np.clip(unit @ centre, -1, 1)) - widest - WIDER
    out = lengths * np.cos(np.clip(angle, 0, math.pi))
    return out + 1e-9 * np.abs(out)


def _scores(x: np.ndarray, anchors: np.ndarray, greatest: float) -> np.ndarray:
    """Exact inner products; ``greatest`` is no less than any of them."""
    kind = np.float32 if greatest < 1 << 24 else np.float64 if greatest < 1 << 53 else np.int64
    return (x.astype(kind) @ anchors.astype(kind).T).astype(np.int64)


class Wanted:
    """Anchors of one dimension and what each asks for: the ``k`` best rows with a score in each
    of its ranges. ``least`` is what a row must have to count, and rises."""

    def __init__(self, asked: dict, k: int):
        self.__dict__.update(asked)
        self.k = k
        self.least = np.array(self.low)
        self.found: dict[tuple[int, int], list[tuple]] = {}

    def walk(self, members: np.ndarray, chunk: dict, order: np.ndarray, bound: np.ndarray, same: bool) -> None:
        """Members of a cluster walk the rows ``order`` of the chunk, whose bounds fall."""
        for some in range(0, len(members), MEMBERS):
            self._walk(members[some : some + MEMBERS], chunk, order, bound, same)

    def _walk(self, members: np.ndarray, chunk: dict, order: np.ndarray, bound: np.ndarray, same: bool) -> None:
        at, stride = 0, STRIDE
        while at < len(order):
            needed = self.least[members].min(axis=1)
            members = members[np.floor(self.lengths[members] * bound[at] + 1) >= needed]
            if not len(members):
                return
            rows = order[at : at + stride]
            greatest = 1 + self.lengths[members].max() * chunk["lengths"][rows].max()
            scores = _scores(chunk["x"][rows], self.x[members], greatest).T
            open_rows = chunk["row"][rows] != self.row[members][:, None]
            if not same:
                open_rows &= chunk["label"][rows] != self.label[members][:, None]
            for j in range(self.low.shape[1]):
                hits = open_rows & (scores >= self.least[members, j][:, None])
                hits &= scores <= self.high[members, j][:, None]
                for m in np.flatnonzero(hits.any(axis=1)):
                    [here] = np.nonzero(hits[m])
                    self._add(int(members[m]), j, scores[m][here], rows[here], chunk)
            at += stride
            stride = min(2 * stride, LONGEST_STRIDE)

    def _add(self, member: int, j: int, scores: np.ndarray, rows: np.ndarray, chunk: dict) -> None:
        ids, null, row = chunk["vec_id"][rows], chunk["null"][rows], chunk["row"][rows]
        order = np.lexsort((row, ids, null, -scores))[: self.k]
        new = zip((-scores[order]).tolist(), null[order].tolist(), ids[order].tolist(), row[order].tolist())
        best = sorted([*self.found.get((member, j), []), *new])[: self.k]
        self.found[member, j] = best
        if len(best) == self.k:
            self.least[member, j] = max(self.least[member, j], -best[-1][0])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows by dimension, so many at a time."""
    kept: dict[int, list[tuple]] = {}

    def chunk(dims: int) -> dict:
        row, ids, label, _, _, scaled = zip(*kept.pop(dims), strict=True)
        x = _matrix(scaled, dims)
        lengths = _lengths(x)
        return {
            "dims": dims, "row": np.array(row), "null": np.array([i is None for i in ids]),
            "vec_id": np.array([0 if i is None else i for i in ids], dtype=np.int64),
            "label": np.array(label), "x": x, "lengths": lengths, "unit": _units(x, lengths),
        }

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            own = kept.setdefault(row[4], [])
            own.append(row)
            if len(own) >= CHUNK_ROWS or len(own) * row[4] * 4 >= CHUNK_BYTES:
                yield chunk(row[4])
    for dims in list(kept):
        yield chunk(dims)


def _by_label(members: np.ndarray, label: np.ndarray, order: np.ndarray, of_rows: np.ndarray):
    """Members and rows of each label that both have, rows in the order they were in."""
    members = members[np.argsort(label[members], kind="stable")]
    order = order[np.argsort(of_rows[order], kind="stable")]
    both = np.intersect1d(label[members], of_rows[order])
    cuts = [np.searchsorted(x, both, side) for x in (label[members], of_rows[order]) for side in ("left", "right")]
    for a, b, c, d in zip(*cuts, strict=True):
        yield members[a:b], order[c:d]


def _walked(batches: Iterator[pa.RecordBatch], asked: dict, k: int, same: bool):
    wanted = {dims: Wanted(own, k) for dims, own in asked.items()}
    for chunk in _chunks(batches):
        if chunk["dims"] not in wanted:
            continue
        own = wanted[chunk["dims"]]
        for c, (centre, widest) in enumerate(zip(own.centres, own.widest, strict=True)):
            bound = bounds(chunk["unit"], chunk["lengths"], centre, widest)
            order = np.lexsort((chunk["row"], -bound))
            [members] = np.nonzero(own.cluster == c)
            if not same:
                own.walk(members, chunk, order, bound[order], same)
                continue
            # Positives have the anchor's label, so each label walks its part of the list.
            for theirs, part in _by_label(members, own.label, order, chunk["label"]):
                own.walk(theirs, chunk, part, bound[part], same)
    for dims, own in wanted.items():
        rows = [
            (dims, member, j, -score, None if null else vec_id, row)
            for (member, j), best in own.found.items()
            for score, null, vec_id, row in best
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _FOUND.types, strict=True)],
                schema=_FOUND,
            )


_FOUND = pa.schema([
    ("dims", pa.int32()), ("member", pa.int32()), ("range", pa.int32()), ("score", pa.int64()),
    ("vec_id", pa.int64()), ("row", pa.int64()),
])
_FOUND_SQL = "dims int, member int, range int, score long, vec_id long, row long"


def _best(rows: DataFrame, asked: dict, k: int, same: bool) -> DataFrame:
    """The ``k`` best of ``rows`` for each range of each anchor, with rank."""
    known = rows.sparkSession.sparkContext.broadcast(asked)
    walked = rows.mapInArrow(lambda batches: _walked(batches, known.value, k, same), _FOUND_SQL)
    order = Window.partitionBy("dims", "member", "range").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row"
    )
    return walked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_floors(rows: DataFrame, asked: dict, k: int, same: bool) -> dict:
    """What is asked, its ranges cut to what a share of the rows shows to be there anyway."""
    share = rows.where(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0)
    last = _best(share, asked, k, same).where(F.col("rank") == k)
    out = {dims: {**own, "low": np.array(own["low"])} for dims, own in asked.items()}
    for r in last.select("dims", "member", "range", "score").collect():
        low = out[r.dims]["low"]
        low[r.member, r.range] = max(low[r.member, r.range], r.score)
    return out


def _asked(anchors: list) -> dict[int, dict]:
    """A block of anchors by dimension, clustered, each asking for the best whatever the score."""
    out = {}
    for dims in sorted({a.dims for a in anchors}):
        own = [a for a in anchors if a.dims == dims]
        x = _matrix([a.scaled for a in own], dims)
        centres, cluster, widest = clusters_of(x)
        one = (len(own), 1)
        out[dims] = {
            "row": np.array([a.row for a in own]), "label": np.array([a.label for a in own]),
            "vec_id": [a.vec_id for a in own], "x": x, "lengths": _lengths(x) * (1 + 1e-12),
            "centres": centres, "cluster": cluster, "widest": widest,
            "low": np.full(one, NOTHING), "high": np.full(one, -NOTHING),
        }
    return out


def _in_ranges(asked: dict, positives: list, most: int, lowest: int, highest: int) -> dict:
    """The same anchors, asking for the scores that each of their positives allows."""
    out = {}
    for dims, own in asked.items():
        shape = len(own["row"]), most
        # A range that nothing can be in, for anchors with fewer positives.
        out[dims] = own | {"low": np.full(shape, -NOTHING), "high": np.full(shape, NOTHING)}
    for p in positives:
        low, high = -(-lowest * p.score // 100), highest * p.score // 100
        if low <= high:
            out[p.dims]["low"][p.member, p["rank"] - 1] = low
            out[p.dims]["high"][p.member, p["rank"] - 1] = high
    return out


def _mine_block(rows: DataFrame, anchors: list, k: int, n: int, lowest: int, highest: int) -> DataFrame:
    spark = rows.sparkSession
    asked = _asked(anchors)
    positives = _best(rows, _with_floors(rows, asked, k, True), k, True).collect()
    ranged = _with_floors(rows, _in_ranges(asked, positives, k, lowest, highest), n, False)
    names = [
        (p.dims, p.member, p["rank"] - 1, asked[p.dims]["vec_id"][p.member], p.vec_id, p.score)
        for p in positives
    ]
    # At most ``k`` for each anchor of the block.
    named = spark.createDataFrame(
        names, "dims int, member int, range int, anchor_id long, positive_id long, positive_score long"
    )
    negatives = _best(rows, ranged, n, False)
    return staged(
        negatives.join(named, ["dims", "member", "range"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ),
        "negatives",
    )


def mine(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    lowest: int = LOWEST, highest: int = HIGHEST,
) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding, other columns are left out; ``anchors`` tells by
    them which rows are anchors. Components are scaled by 256 and rounded down. An anchor's
    positives are the first other rows of its label by score, then vec_id (a null one last); its
    negatives for a positive are the first rows of other labels whose score is ``lowest`` to
    ``highest`` percent of the positive's. Every row counts, so a repeated row is another row, and
    is an anchor of its own if one is. Rows with a null label, a null vector or a null or non-finite
    component take no part, nor do vectors longer than 2**23, whose scores may pass 64 bits. Vectors
    of another length than the anchor's have no score with it. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    known = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col("embedding").alias("vector"),
    )
    rows = staged(known.mapInArrow(_scaled, _ROWS_SQL), "scaled")
    chosen = rows.where("anchor")
    n, size = chosen.agg(F.count("*"), F.sum(F.octet_length("scaled"))).first()
    # A block of anchors at a time, each against all rows.
    blocks = max(math.ceil(n / BLOCK_ANCHORS), math.ceil((size or 0) / BLOCK_BYTES))
    out = None
    for block in range(blocks):
        own = chosen.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()
        if own:
            own = sorted(own, key=lambda a: a.row)
            found = _mine_block(rows, own, positives, negatives, lowest, highest)
            out = found if out is None else out.unionAll(found)
    discard(rows)
    if out is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, "
            "positive_score long, negative_score long",
        )
    return out
