import random
from collections import Counter

import pytest

from headway.llm import forest
from headway.llm.components import components


def brute(rows, threshold=0.8, k=5):
    """doc_id, class, copies and links of (id, text) rows by comparing all."""
    def shingles(text):
        words = (text or "").split()
        if len(words) < k:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}

    texts = list(dict.fromkeys(t for _, t in rows if shingles(t)))
    sets = [shingles(t) for t in texts]
    near = [
        [j for j, b in enumerate(sets) if j != i and len(a & b) >= threshold * len(a | b)]
        for i, a in enumerate(sets)
    ]
    group = list(range(len(texts)))
    for _ in texts:
        group = [min(group[j] for j in [i, *near[i]]) for i in range(len(texts))]
    first = {}
    for i, t in rows:
        if shingles(t):
            g = group[texts.index(t)]
            first[g] = min(first.get(g, i), i)
    copies = Counter(t for _, t in rows)
    return sorted(
        (i, first[group[texts.index(t)]], copies[t], len(near[texts.index(t)]))
        if shingles(t) else (i, i, 1, 0)
        for i, t in rows
    )


def made():
    rnd = random.Random(3)
    prose = lambda n: " ".join(rnd.choices([f"w{i}" for i in range(400)], k=n))

    def edited(text, n):
        words = text.split()
        for at in rnd.sample(range(len(words)), n):
            words[at] = "edit" + str(rnd.random())
        return " ".join(words)

    a, b, c = prose(120), prose(60), prose(200)
    texts = [a, a, a, edited(a, 1), edited(a, 2), edited(a, 9), b, edited(b, 1), b + " tail", c]
    texts += [edited(c, n % 5) for n in range(60)]
    texts += [None, "", " \n", None, "", "one two", "one two", "one  two", "one two three", "z " * 40, "z " * 90]
    return list(enumerate(texts + [prose(30) for _ in range(20)]))


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "class_id", "n_copies", "n_links").collect())


@pytest.mark.parametrize("block", [512, 8])
def test_against_brute_force(documents, monkeypatch, block):
    # Small blocks, so that a group is compared in pairs of blocks.
    monkeypatch.setattr(forest, "BLOCK_NODES", block)
    rows = made()
    assert result(forest.near_duplicates(documents(rows))) == brute(rows)


def test_repeated_rows_and_null_ids(documents):
    text = "a b c d e f g h"
    rows = forest.near_duplicates(documents([(7, text), (7, text), (None, text), (9, "other words")]))
    got = sorted((r.doc_id or 0, r.class_id, r.n_copies, r.n_links) for r in rows.collect())
    assert [g[2:] for g in got] == [(3, 0), (3, 0), (3, 0), (1, 0)]
    assert len({g[1] for g in got[:3]}) == 1


def test_one_of_each_keeps_columns(documents):
    docs = documents([(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, None), (5, "x"), (5, "x")])
    kept = forest.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]


def test_empty_table(empty):
    assert forest.near_duplicates(empty).collect() == []
    assert forest.one_of_each(empty).collect() == []


def test_prefixes_are_shortened_until_the_recall():
    lengths = forest.depths(0.8, 24, 8, 0.999)
    assert lengths == [8, 7, 6]
    assert forest.recall_at(6, 0.8, 24) >= 0.999 > forest.recall_at(7, 0.8, 24)
    assert forest.depths(0.99, 24, 8, 0.9) == [8]
    assert forest.depths(0.1, 2, 5, 1.1) == [5, 4, 3, 2, 1]


def test_labels_are_prefixes_of_each_other():
    import pyarrow as pa

    texts = [b"a b c d e f g", b"a b c d e f g", b"", b"a b c d e f x", b"q"]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": range(5), "text_key": texts, "content": texts},
        schema=pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("content", pa.binary())]),
    )
    [long] = forest._labeller(5, 7, 2, 5)(iter([batch]))
    [short] = forest._labeller(5, 7, 2, 5)(iter([batch.slice(3, 1)]))
    assert long.column("doc_id").to_pylist() == [0, 1, 3, 4]
    labels = long.column("labels").to_pylist()
    assert labels[0] == labels[1] and {len(t) for t in labels[0]} == {4} and len(labels[0]) == 7
    assert short.column("labels").to_pylist() == [labels[2]]
    # Two labels that agree at a length agree at all shorter ones.
    for a, b in zip(labels[0], labels[2]):
        same = [x == y for x, y in zip(a, b)]
        assert same == sorted(same, reverse=True)


def test_weak_chains_do_not_join(documents):
    """Texts each some 0.7 alike to the next: candidates, but no links."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(40):
        words = words[6:] + [f"x{rnd.random()}" for _ in range(6)]
        for at in rnd.sample(range(len(words)), 4):
            words[at] = f"y{rnd.random()}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    assert result(forest.near_duplicates(documents(rows))) == brute(rows)


def test_pivots_of_many_classes(documents, monkeypatch):
    monkeypatch.setattr(forest, "PIVOT_CLASSES", 3)
    rows = made()
    assert result(forest.near_duplicates(documents(rows))) == brute(rows)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    links += [(301, 300), (302, 301)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {i: 300 for i in (300, 301, 302)}
    assert got == want
