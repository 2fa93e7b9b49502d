"""Ranked lexical search: the best documents of each item, by pair-bound MaxScore.

Documents are read once to postings of the items' terms, a row a document, which no shuffle moves.
A second pass takes them by shards within its tasks: a shard's postings become lists by term with
their greatest impact, and for the pairs of each item's heaviest terms the lists are intersected
and the greatest joint impact is kept. An item's terms are then matched to pairs whose joint bound is
below the sum of their two; terms and pairs are units, and a shard of which all units together fall
short of the item's threshold is passed over. Else documents come from the essential units alone,
and are dropped as soon as what they have and the bounds of the units left cannot reach the
threshold. That rises from shard to shard within a task, and is never above the score of the last
document that the task would return, so results are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.stage import discard, slices, staged

TOP = 20
# Text of the items searched together, in bytes; their terms and pairs are broadcast.
BLOCK_BYTES = 2 << 20
# Postings of one shard.
SHARD_POSTINGS = 1 << 20
# Heaviest terms of an item that are paired with each other.
PAIRED = 10
# Parts in which an item's documents from all tasks are ranked first.
SALTS = 64
# Terms are runs of ASCII letters and digits and of all other characters; A-Z become lower case.
_SEPARATORS = [c for c in range(128) if not chr(c).isalnum()]
_TABLE = bytes(32 if c in _SEPARATORS else c + 32 if 65 <= c <= 90 else c for c in range(256))

_POSTINGS = "doc_id long, n long, terms binary, tfs binary"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_TABLE).split() if text else []


def _to_postings(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]):
    for batch in batches:
        for part in slices([batch], "text"):
            rows = [[], [], [], []]
            for doc_id, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                words = terms_of(text)
                if not words:
                    continue
                own = [(vocabulary[w], tf) for w, tf in Counter(words).items() if w in vocabulary]
                pairs = np.array(own, dtype=np.int32).reshape(-1, 2)
                row = doc_id, len(words), pairs[:, 0].tobytes(), pairs[:, 1].tobytes()
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, _ARROW.types, strict=True)], schema=_ARROW
            )


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tfs", pa.binary())]
)


def _holding(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Documents of one task that hold each term."""
    held = np.zeros(size, dtype=np.int64)
    for batch in batches:
        terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype=np.int32)
        held += np.bincount(terms, minlength=size)
    [at] = np.nonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["term", "df"])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def heaviest_pairs(item: dict[int, int], weights: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of the item's heaviest terms, smaller term first."""
    top = sorted(item, key=lambda t: (-item[t] * int(weights[t]), t))[:PAIRED]
    return [(min(a, b), max(a, b)) for i, a in enumerate(top) for b in top[i + 1 :]]


class Shard:
    """Postings of some documents by term, with impacts, their maxima, and joint maxima of pairs."""

    def __init__(self, rows: list[tuple], model: dict):
        ids, sizes, terms, tfs = zip(*rows, strict=True)
        self.null = np.array([i is None for i in ids])
        self.doc_id = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        n_docs, length = model["n_docs"], model["length"]
        # Python's integers, as a long text in a large corpus passes 64 bits.
        norm = np.array([75 + 25 * n * n_docs // length for n in sizes], dtype=np.int64)
        term = np.frombuffer(b"".join(terms), dtype=np.int32)
        tf = np.frombuffer(b"".join(tfs), dtype=np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), [len(t) // 4 for t in terms])
        order = np.argsort(term, kind="stable")
        term, tf, self.docs = term[order], tf[order], doc[order]
        self.impacts = model["weights"][term] * (1_000_000_000 * tf // (1000 * tf + 12 * norm[self.docs]))
        present, start = np.unique(term, return_index=True)
        stop = np.r_[start[1:], len(term)]
        self.lists = {
            t: (a, b) for t, a, b in zip(present.tolist(), start.tolist(), stop.tolist(), strict=True)
        }
        top = np.maximum.reduceat(self.impacts, start) if len(start) else []
        self.top = dict(zip(present.tolist(), map(int, top), strict=True))
        self.joint = self._joint(sorted(set().union(*model["pairs"])))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.lists[term]
        return self.docs[a:b], self.impacts[a:b]

    def _joint(self, pairs: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
        """The greatest sum of two impacts in a document that has both; 0 if none has."""
        out, spread, last = {}, np.zeros(len(self.doc_id), dtype=np.int64), None
        for a, b in pairs:
            if a not in self.lists or b not in self.lists:
                continue
            if a != last:
                if last is not None:
                    spread[self.of(last)[0]] = 0
                docs, impacts = self.of(a)
                spread[docs] = impacts
                last = a
            docs, impacts = self.of(b)
            other = spread[docs]
            out[a, b] = int(np.where(other > 0, other + impacts, 0).max())
        return out


def units_of(
    item: dict[int, int], pairs: list[tuple[int, int]], shard: Shard
) -> list[tuple[int, list[int]]]:
    """The item's terms in the shard as units of one or two, each with its bound, least first.

    Two terms become one unit if no document of the shard can have as much of both as their own
    maxima add up to; pairs that save most are taken first.
    """
    single = {t: n * shard.top[t] for t, n in item.items() if t in shard.top}
    saved = []
    for a, b in pairs:
        if (a, b) not in shard.joint:
            continue
        # With unequal repeats the joint maximum counts as often as the more frequent of the two.
        both = min(max(item[a], item[b]) * shard.joint[a, b], single[a] + single[b])
        bound = max(both, single[a], single[b])
        if bound < single[a] + single[b]:
            saved.append((bound - single[a] - single[b], a, b, bound))
    units, used = [], set()
    for _, a, b, bound in sorted(saved):
        if a not in used and b not in used:
            used |= {a, b}
            units.append((bound, [a, b]))
    units += [(bound, [t]) for t, bound in single.items() if t not in used]
    return sorted(units)


class Best:
    """The best documents of one item so far, in order."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.empty(0, dtype=np.int64)
        self.doc_id = np.empty(0, dtype=np.int64)
        self.null = np.empty(0, dtype=bool)

    @property
    def threshold(self) -> int:
        """Least score that can still count; a score must be above 0."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc_id: np.ndarray, null: np.ndarray) -> None:
        score, doc_id = np.r_[self.score, score], np.r_[self.doc_id, doc_id]
        null = np.r_[self.null, null]
        order = np.lexsort((doc_id, null, -score))[: self.k]
        self.score, self.doc_id, self.null = score[order], doc_id[order], null[order]


def evaluate(
    item: dict[int, int], pairs: list[tuple[int, int]], shard: Shard, best: Best
) -> None:
    """Adds the shard's documents that are among the item's best to them."""
    units = units_of(item, pairs, shard)
    least = best.threshold
    if sum(bound for bound, _ in units) < least:
        return
    rest, at = 0, 0
    while at < len(units) and rest + units[at][0] < least:
        rest += units[at][0]
        at += 1
    scores = np.zeros(len(shard.doc_id), dtype=np.int64)
    for _, terms in units[at:]:
        for term in terms:
            docs, impacts = shard.of(term)
            scores[docs] += item[term] * impacts
    [found] = np.nonzero(scores)
    own = scores[found]
    for bound, terms in [*reversed(units[:at]), (0, [])]:
        if len(found) > best.k:
            # What a document has already it keeps, so the k-th of these is below the last's score.
            least = max(least, int(np.partition(own, -best.k)[-best.k]))
        there = own + rest >= least
        found, own = found[there], own[there]
        if not len(found):
            return
        for term in terms:
            docs, impacts = shard.of(term)
            place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            own = own + np.where(docs[place] == found, item[term] * impacts[place], 0)
        rest -= bound
    best.add(own, shard.doc_id[found], shard.null[found])


def _shards(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[Shard]:
    rows, size = [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[2]:
                rows.append(row)
                size += len(row[2]) // 4
            if size >= SHARD_POSTINGS:
                yield Shard(rows, model)
                rows, size = [], 0
    if rows:
        yield Shard(rows, model)


def _ranked(batches: Iterator[pa.RecordBatch], model: dict, k: int) -> Iterator[pa.RecordBatch]:
    best = [Best(k) for _ in model["items"]]
    for shard in _shards(batches, model):
        for item, pairs, own in zip(model["items"], model["pairs"], best, strict=True):
            evaluate(item, pairs, shard, own)
    for at, own in enumerate(best):
        n = len(own.score)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at] * n, pa.int32()), pa.array([model["item_ids"][at]] * n, pa.int64()),
                    pa.array(own.doc_id, pa.int64(), mask=own.null), pa.array(own.score, pa.int64()),
                ],
                ["item", "item_id", "doc_id", "score"],
            )


def _first(rows: DataFrame, by: list, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, asked: list, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    items = []
    for row in asked:
        counts = Counter(terms_of(row.text))
        items.append({vocabulary.setdefault(t, len(vocabulary)): n for t, n in counts.items()})
    size = len(vocabulary)
    known = spark.sparkContext.broadcast(vocabulary)
    postings = staged(
        docs.mapInArrow(lambda batches: _to_postings(batches, known.value), _POSTINGS), "postings"
    )
    n_docs, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row for each of the items' terms.
    held = postings.select("terms").mapInArrow(lambda b: _holding(b, size), "term int, df long")
    weights = np.zeros(size, dtype=np.int64)
    for row in held.groupBy("term").agg(F.sum("df").alias("df")).collect():
        weights[row.term] = weight(n_docs, row.df)
    model = spark.sparkContext.broadcast({
        "items": items, "item_ids": [row.item_id for row in asked], "n_docs": n_docs,
        "length": length, "weights": weights, "pairs": [heaviest_pairs(own, weights) for own in items],
    })
    ranked = postings.mapInArrow(
        lambda batches: _ranked(batches, model.value, k),
        "item int, item_id long, doc_id long, score long",
    )
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
    first = _first(_first(ranked, ["item", salt], k).drop("rank"), ["item"], k)
    out = staged(first.select("item_id", "rank", "doc_id", "score"), "ranked")
    discard(postings)
    known.unpersist()
    model.unpersist()
    return out


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are left out. Every row
    of ``docs`` is a document, so repeated rows take ranks of their own; equal rows of ``items`` are
    one item, and rows with one item_id and other texts each have their results. Ties go by doc_id,
    a null one last. A null or empty text, an item without terms and an item whose terms no document
    has give no rows, as do empty tables.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    asked = asked.where(F.col("text").isNotNull()).distinct()
    asked = staged(asked.withColumn("share", F.xxhash64("item_id", "text")), "items")
    n_bytes = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(n_bytes / BLOCK_BYTES)
    out = None
    for block in range(blocks):
        # A block of items at a time, each against all documents.
        own = asked.where(F.pmod("share", F.lit(blocks)) == block).drop("share").collect()
        if own:
            found = _search_block(docs, own, k)
            out = found if out is None else out.unionAll(found)
    discard(asked)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
