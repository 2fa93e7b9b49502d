"""Near-duplicate join by Jaccard similarity of word shingles, through a MinHash LSH forest.

Each distinct text has a label in each of ``TREES`` trees, a sequence of min-hashes. The labels of a
tree, by prefix, are a trie: texts that share a prefix are candidates, and the longer it is, the more
alike they are likely to be. Prefixes are shortened from the longest, until texts just at the
threshold share one in some tree with the target recall; no shorter prefix is ever asked for, so what
comes before it is one number, and texts that share none of that length leave at once.

At each length texts are compared exactly, but only where a prefix is shared by texts that are not yet
in one class: first each class's first text with a pivot of its part of the trie, which joins most of
what belongs together at the price of a comparison a class; and at the last length, where classes
still meet, all texts of different classes. So texts join by verified links alone.

Exact copies are one node from the start. In the end each class counts its links, compared in blocks of
bounded size, a pair of blocks to a task, which gives counts a node: never all pairs. So a class of any
size is compared whole, and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.components import components
from headway.llm.stage import as_id, discard, free_names, id_key, slices, staged
from headway.llm.words import WordSplitter, mixed, shingles

K = 5
THRESHOLD = 0.8
TREES = 24
LONGEST = 8
RECALL = 0.999
# Most nodes and words of a block, on average, and classes of a pivot.
BLOCK_NODES = 512
BLOCK_WORDS = 500_000
PIVOT_CLASSES = 256


def recall_at(depth: int, threshold: float, trees: int) -> float:
    """Probability that two texts at the threshold share a prefix of some length in some tree."""
    return 1 - (1 - threshold**depth) ** trees


def depths(threshold: float, trees: int, longest: int, recall: float) -> list[int]:
    """Lengths of prefixes to look at: from the longest to the first that has the recall."""
    out = [longest]
    while out[-1] > 1 and recall_at(out[-1], threshold, trees) < recall:
        out.append(out[-1] - 1)
    return out


def _labeller(k: int, trees: int, shortest: int, longest: int):
    """Each tree's prefixes of a text, from the shortest length to the longest, as a number each."""
    kept = longest - shortest + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = WordSplitter()
        odd = np.random.default_rng(3).integers(0, 1 << 63, trees * longest, dtype=np.uint64) * 2 + 1
        mix = np.random.default_rng(5).integers(0, 1 << 63, longest, dtype=np.uint64) * 2 + 1
        for batch in slices(batches, "content"):
            words = splitter.split(batch.column("content").to_pylist())
            hashes, text = shingles(words, k)
            have = np.flatnonzero(np.bincount(text, minlength=batch.num_rows))
            labels = np.zeros((len(have), trees, kept), dtype=np.uint64)
            if len(have):
                starts = np.searchsorted(text, have)
                for tree in range(trees):
                    prefix = np.zeros(len(have), dtype=np.uint64)
                    for level in range(longest):
                        low = np.minimum.reduceat(hashes * odd[tree * longest + level], starts)
                        prefix = (prefix ^ (low >> np.uint64(7))) * mix[level] + low
                        if level + 1 >= shortest:
                            labels[:, tree, level + 1 - shortest] = prefix
            rows = labels.view(np.int64).ravel()
            each = pa.ListArray.from_arrays(np.arange(0, len(rows) + 1, kept, dtype=np.int32), rows)
            lists = pa.ListArray.from_arrays(
                np.arange(0, len(have) * trees + 1, trees, dtype=np.int32), each
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(have)),
                    batch.column("text_key").take(pa.array(have)),
                    pa.array(np.diff(words.first)[have]),
                    lists,
                ],
                ["doc_id", "text_key", "n_words", "labels"],
            )

    return run


def _linked(sets: list[np.ndarray], threshold: float, cross: list[np.ndarray]):
    """Which of the shingle sets are at least ``threshold`` alike, among pairs that differ in each
    of ``cross``."""
    n = len(sets)
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=n)
    owner = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    new = np.r_[True, values[1:] != values[:-1]]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1 if len(column) else column
    both = np.zeros((n, n), dtype=np.float32)
    width = max(1, 2_000_000 // n)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((n, width), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    alike = both >= threshold * union - 1e-6
    np.fill_diagonal(alike, False)
    for part in cross:
        alike &= part[:, None] != part[None, :]
    return alike


def _smallest(alike: np.ndarray) -> np.ndarray:
    """First member of the component of each node."""
    label = np.arange(len(alike))
    while True:
        low = np.where(alike, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _comparer(k: int, threshold: float, across: bool):
    """Compares the nodes of a group and pair of blocks; ``across``: only those of different
    classes."""

    def compared(group: list[dict], splitter: WordSplitter) -> dict:
        unique = list({row["node"]: row for row in group}.values())
        words = splitter.split([row["content"] for row in unique])
        hashes, text = shingles(words, k)
        cuts = np.searchsorted(text, np.arange(len(unique) + 1))
        sets = [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        one = unique[0]
        cross = [np.array([row["block"] for row in unique])] if one["low"] != one["high"] else []
        if across:
            cross.append(np.array([row["class"] for row in unique]))
        alike = _linked(sets, threshold, cross)
        node = np.array([row["node"] for row in unique], dtype=np.int64)
        n = alike.sum(axis=1)
        have = n > 0
        return {"a": node[have], "b": node[_smallest(alike)][have], "n": n[have].astype(np.int64)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, group, at = WordSplitter(), [], None
        for batch in batches:
            for row in batch.to_pylist():
                key = row["group"], row["low"], row["high"]
                if key != at and group:
                    yield pa.RecordBatch.from_pydict(compared(group, splitter))
                    group = []
                at = key
                group.append(row)
        if group:
            yield pa.RecordBatch.from_pydict(compared(group, splitter))

    return run


def _pair_checker(k: int, threshold: float):
    """Pairs of texts at least ``threshold`` alike."""
    salt = np.uint64(0x9FB21C651E98DF25)

    def keyed(texts: list[bytes], splitter: WordSplitter) -> tuple[np.ndarray, np.ndarray]:
        """Different shingles of each text, told apart by the text's number, and that number."""
        hashes, text = shingles(splitter.split(texts), k)
        key, first = np.unique(mixed(hashes + text.astype(np.uint64) * salt), return_index=True)
        return key, text[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = WordSplitter()
        for outer in slices(batches, "content_a"):
            for batch in slices([outer], "content_b"):
                n = batch.num_rows
                a, of_a = keyed(batch.column("content_a").to_pylist(), splitter)
                b, of_b = keyed(batch.column("content_b").to_pylist(), splitter)
                both = np.bincount(of_a[np.isin(a, b, assume_unique=True)], minlength=n)
                union = np.bincount(of_a, minlength=n) + np.bincount(of_b, minlength=n) - both
                alike = pa.array(both >= threshold * union - 1e-6)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).filter(alike) for c in ("a", "b")], ["a", "b"]
                )

    return run


def _mixed_parts(forest: DataFrame, classes: DataFrame | None, length: int) -> DataFrame:
    """Nodes under the prefixes that nodes of several classes share, of a length counted from the
    shortest: tree, prefix, label, node, class, and n, the number of nodes under the prefix.
    Prefixes under which the very same nodes lie count once."""
    if classes is None:
        known = forest.withColumn("class", F.col("node"))
    else:
        known = forest.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    rows = known.withColumn("prefix", F.col("label")[length])
    several = rows.groupBy("tree", "prefix").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("who"),
    ).where("low < high")
    once = several.groupBy("n", "who").agg(F.min(F.struct("tree", "prefix")).alias("first"))
    return rows.join(once.select("first.*", "n"), ["tree", "prefix"])


def _pivot_pairs(parts: DataFrame) -> DataFrame:
    """The first node of each class under a prefix with a pivot, the first of them all. Under a
    prefix of many classes each pivot has so many, and is set against the first pivot itself."""
    firsts = parts.groupBy("tree", "prefix", "class").agg(F.min("node").alias("node"), F.max("n").alias("n"))
    share = F.pmod(F.xxhash64("class"), F.ceil(F.col("n") / PIVOT_CLASSES)).alias("share")
    firsts = firsts.select("tree", "prefix", "node", share)
    pivots = firsts.groupBy("tree", "prefix", "share").agg(F.min("node").alias("pivot"))
    top = pivots.groupBy("tree", "prefix").agg(F.min("pivot").alias("top"))
    own = firsts.join(pivots, ["tree", "prefix", "share"]).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    upper = pivots.join(top, ["tree", "prefix"]).select(F.col("pivot").alias("a"), F.col("top").alias("b"))
    return own.unionAll(upper).where("a != b").distinct()


def _joined(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """Classes of nodes, joined by verified links: node, class. Nodes alone are left out."""
    if links.isEmpty():
        return classes
    if classes is None:
        return staged(components(links).select("node", F.col("label").alias("class")), "classes")
    of = classes.select(F.col("node"), F.col("class"))
    ends = links.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(of.select(F.col("node").alias(end), F.col("class").alias(f"c{end}")), end, "left")
    joined = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    joined = staged(joined, "joined")
    # Nodes of classes that were joined, classes that were not, and nodes that were alone.
    moved = of.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "node", F.coalesce("label", "class").alias("class")
    )
    alone = joined.join(of.select("node"), "node", "left_anti").select("node", F.col("label").alias("class"))
    out = staged(moved.unionAll(alone), "classes")
    discard(joined, classes)
    return out


def _dealt(members: DataFrame, contents: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Nodes with their texts, dealt to each pair of blocks of their group that theirs is one of."""
    sized = members.join(contents.select("node", "n_words"), "node")
    blocks = sized.groupBy(*group).agg(
        F.ceil(
            F.greatest(F.count("*") / BLOCK_NODES, F.sum("n_words") / BLOCK_WORDS)
        ).cast("int").alias("blocks")
    )
    placed = members.join(blocks, group).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    dealt = placed.join(contents.select("node", "content").hint("merge"), "node").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "node", F.xxhash64(*group).alias("group"), "block", "content", *columns,
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    by = ["group", "low", "high"]
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    return dealt.repartition(tasks, *by).sortWithinPartitions(*by)


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    k: int = K,
    trees: int = TREES,
    longest: int = LONGEST,
    recall: float = RECALL,
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id and text; other columns are left out): doc_id,
    class_id (smallest doc_id of all that are joined to it by copies and links), n_copies (rows of
    its very text, itself among them) and n_links (different texts at least ``threshold`` alike).

    A null text or one without words is alone in its class, with no link. A text of fewer than
    ``k`` words has one shingle. Repeated rows are copies of each other.
    """
    lengths = depths(threshold, trees, longest, recall)
    content = docs.select(
        id_key().alias("doc_id"),
        F.unhex(F.md5("text")).alias("text_key"),
        F.coalesce("text", F.lit("")).cast("binary").alias("content"),
    )
    labelled = staged(
        content.mapInArrow(
            _labeller(k, trees, lengths[-1], longest),
            "doc_id long, text_key binary, n_words long, labels array<array<long>>",
        ),
        "labels",
    )
    texts = labelled.groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), F.max("n_words").alias("n_words")
    )
    # Numbered when written, so that a task run again finds the same numbers.
    texts = staged(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    key = ["text_key", "doc_id"]
    below = labelled.select(*key, "labels").join(texts, key).select(
        "node", F.posexplode("labels").alias("tree", "label")
    )
    shared = below.groupBy("tree", F.col("label")[0].alias("shared")).agg(
        F.min("node").alias("first"), F.max("node").alias("last")
    ).where("first < last").select("tree", "shared")
    forest = below.withColumn("shared", F.col("label")[0]).join(shared, ["tree", "shared"], "left_semi")
    # Rows alike in id and text are there once.
    forest = staged(forest.select("tree", "label", "node").distinct(), "forest")
    some = forest.select("node").distinct().join(texts, "node").select("node", "n_words", *key)
    # Candidates grow with the corpus, so their texts are shuffled at any size.
    contents = staged(
        content.join(some.hint("merge"), key).dropDuplicates(["node"]).select("node", "n_words", "content"),
        "contents",
    )
    discard(labelled)

    classes = None
    for depth in lengths:
        # Where no two classes share a prefix of some length, there is nothing to compare.
        parts = _mixed_parts(forest, classes, depth - lengths[-1])
        if depth < longest and parts.isEmpty():
            continue
        pairs = _pivot_pairs(parts)
        for end in ("a", "b"):
            one = contents.select(F.col("node").alias(end), F.col("content").alias(f"content_{end}"))
            pairs = pairs.join(one.hint("merge"), end)
        links = staged(
            pairs.mapInArrow(_pair_checker(k, threshold), "a long, b long"), "pivot-links"
        )
        classes = _joined(classes, links)
        discard(links)
        # Shorter prefixes matter only where classes meet under the shortest.
        last, met = forest, _mixed_parts(forest, classes, 0).select("tree", "label", "node")
        forest = staged(met, "forest")
        discard(last)
    # Where classes still meet, all their texts are compared.
    parts = staged(_mixed_parts(forest, classes, 0).select("tree", "prefix", "node", "class"), "meeting")
    discard(forest)
    if not parts.isEmpty():
        met = _dealt(parts, contents, ["tree", "prefix"], ["class"])
        links = staged(met.mapInArrow(_comparer(k, threshold, True), "a long, b long, n long"), "links")
        classes = _joined(classes, links)
        discard(links)
    discard(parts)

    if classes is None:
        classes = staged(texts.select("node", F.col("node").alias("class")).limit(0), "classes")
    within = _dealt(classes, contents, ["class"], [])
    counts = within.mapInArrow(_comparer(k, threshold, False), "a long, b long, n long")
    counts = staged(counts.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links")), "counts")
    discard(contents)
    firsts = classes.join(texts.select("node", "doc_id"), "node")
    classes = firsts.join(
        firsts.groupBy("class").agg(F.min("doc_id").alias("class_id")), "class"
    ).select("node", "class_id")
    of_text = (
        texts.join(classes, "node", "left").join(counts, "node", "left")
        .select(
            "text_key",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            "n_copies",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
    ids = content.select("doc_id", "text_key")
    return ids.join(of_text, "text_key", "left").select(
        as_id("doc_id").alias("doc_id"),
        as_id(F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose doc_id is their class's; of repeated
    rows one. A text without words stays, as it is alone in its class."""
    classes = near_duplicates(docs, **options)
    doc, rows = free_names(docs, "doc", "rows")
    first = staged(
        classes.where("doc_id <=> class_id").groupBy(id_key().alias(doc)).agg(
            F.count("*").alias(rows)
        ),
        "firsts",
    )
    kept = docs.join(first, id_key(docs["doc_id"]) == F.col(doc))
    once = kept.where(F.col(rows) == 1).select(*docs.columns)
    if first.where(F.col(rows) > 1).isEmpty():
        return once
    again = kept.where(F.col(rows) > 1).select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return once.unionAll(again)
