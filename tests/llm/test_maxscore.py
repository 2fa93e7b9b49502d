import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from headway.llm import maxscore

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string"


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = set()
    for item_id, text in items:
        asked, found = Counter(terms(text)), []
        for doc_id, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // length
            score = sum(
                q * weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, *_, doc_id) in enumerate(sorted(found)[:k], 1):
            out.add((item_id, rank, doc_id, -score))
    return out


def made(n, seed=1):
    rnd = random.Random(seed)
    words = ["the", "of", "Ärger", "naïve", "x1", "日本"] + [f"w{i}" for i in range(80)]
    heavy = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rnd.choices(words, heavy, k=rnd.randint(1, 40)))) for i in range(n)]


def found(docs, items, spark, documents, k=20):
    table = spark.createDataFrame(items, ITEMS)
    return [tuple(r) for r in maxscore.search(documents(docs), table, k).collect()]


@pytest.mark.parametrize("postings, block", [(1 << 20, 1 << 21), (60, 40)])
def test_against_brute_force(spark, documents, monkeypatch, postings, block):
    monkeypatch.setattr(maxscore, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(maxscore, "BLOCK_BYTES", block)
    docs = made(400)
    items = [(7, "W1 w2, w3-w3 THE of x ärger Ärger"), (8, "w9 w10 w11 w12 w13 w14 w70 w71 w72 w73 w74 w75"),
             (9, "日本 naïve x1"), (10, "nowhere"), (11, "the the the of")]
    for k in (3, 20):
        got = found(docs, items, spark, documents, k)
        assert len(got) == len(set(got)) and set(got) == brute(docs, items, k)


def test_ties_repeats_and_null_ids(spark, documents):
    docs = [(5, "a b"), (3, "a b"), (3, "a b"), (None, "a b"), (1, "b a"), (9, "c d e f"), (2, None), (4, ""), (6, "--")]
    items = [(1, "a"), (1, "a"), (2, "a"), (None, "c"), (3, None), (4, "!"), (1, "f")]
    got = found(docs, items, spark, documents)
    want = brute(docs, [(1, "a"), (2, "a"), (None, "c"), (1, "f")], 20)
    assert set(got) == want
    assert sorted((r, d is None, d or 0) for i, r, d, _ in got if i == 2) == [
        (1, False, 1), (2, False, 3), (3, False, 3), (4, False, 5), (5, True, 0)
    ]
    # Equal rows are one item, other texts of its id another.
    assert len([g for g in got if g[0] == 1]) == 6


def test_empty_tables_and_other_columns(spark, empty, documents):
    items = spark.createDataFrame([(1, "a", 2, "x")], "item_id long, text string, doc_id long, score string")
    assert maxscore.search(empty, items).collect() == []
    docs = documents(["a b"]).selectExpr("*", "1 AS item_id", "2 AS n", "3 AS terms")
    assert [r.doc_id for r in maxscore.search(docs, items).collect()] == [0]
    assert maxscore.search(docs, items.limit(0)).collect() == []


def test_a_long_text_and_one_that_a_third_of_rows_share(spark, documents):
    docs = [(i, "hot spot") for i in range(300)] + [(1000, "word " * 400_000 + "hot"), (1001, "rare hot")]
    docs += [(2000 + i, f"w{i} spot") for i in range(300)]
    items = [(1, "hot rare"), (2, "hot spot w7")]
    assert set(found(docs, items, spark, documents)) == brute(docs, items, 20)


def test_units_bound_every_document_and_pairs_tighten():
    rnd = np.random.default_rng(4)
    tighter = 0
    for _ in range(30):
        rows = []
        for doc in range(60):
            own = rnd.choice(12, rnd.integers(1, 6), replace=False).astype(np.int32)
            rows.append((doc, 20, own.tobytes(), rnd.integers(1, 5, len(own)).astype(np.int32).tobytes()))
        item = {t: int(rnd.integers(1, 3)) for t in range(12)}
        weights = rnd.integers(0, 900, 12)
        pairs = maxscore.heaviest_pairs(item, weights)
        model = {"n_docs": 60, "length": 1200, "weights": weights, "pairs": [pairs]}
        shard = maxscore.Shard(rows, model)
        units = maxscore.units_of(item, pairs, shard)
        assert sorted(t for _, own in units for t in own) == sorted(shard.top)
        for bound, own in units:
            scores = np.zeros(60, dtype=np.int64)
            for t in own:
                docs, impacts = shard.of(t)
                scores[docs] += item[t] * impacts
            assert scores.max() <= bound
        tighter += sum(b for b, _ in units) < sum(item[t] * top for t, top in shard.top.items())
    assert tighter > 20


def test_documents_that_cannot_rank_are_not_scored(monkeypatch):
    rows = [(d, 10, np.array([0, 1] if d < 20 else [1], np.int32).tobytes(),
             np.ones(2 if d < 20 else 1, np.int32).tobytes()) for d in range(2000)]
    model = {"n_docs": 2000, "length": 20_000, "weights": np.array([4000, 10]), "pairs": [[(0, 1)]]}
    shard, best = maxscore.Shard(rows, model), maxscore.Best(20)
    maxscore.evaluate({0: 1, 1: 1}, [(0, 1)], shard, best)
    assert best.doc_id.tolist() == list(range(20))
    touched = []
    monkeypatch.setattr(maxscore.Shard, "of", lambda self, t: touched.append(t) or (np.array([], int),) * 2)
    # The second time round nothing beats what is there: the light term's list is not read.
    best.score = best.score + 1
    maxscore.evaluate({0: 1, 1: 1}, [(0, 1)], shard, best)
    assert touched == []
