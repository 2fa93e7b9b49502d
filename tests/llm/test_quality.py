import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from headway.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False))
               if windows[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), len(seen) + dup,
            sum("A" <= c <= "Z" for c in text), sum("0" <= c <= "9" for c in text),
            sum(c in "!?" for c in text), len(set(words)))


def measured(texts):
    batch = pa.RecordBatch.from_pydict({
        "doc_id": list(range(len(texts))), "text_key": [0] * len(texts),
        "content": [(t or "").encode() for t in texts],
    })
    rows = [r for out in quality._measurer()(iter([batch])) for r in out.to_pylist()]
    return [tuple(r[c] for c in quality.COUNTS) for r in rows]


TEXT = st.lists(st.sampled_from(["a", "b", "é", "A1", "##", "x|y", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\xa0", "!?"]),
                max_size=40).map("".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_counts_against_brute_force(texts):
    assert measured(texts) == [brute(t) for t in texts]


def test_counts_of_long_and_empty_texts():
    texts = ["", None, " \n ", "one two three " * 20_000, "w" * 100_000, "a b c a b c"]
    assert measured(texts) == [brute(t) for t in texts]


def made(n=3000):
    """Bad rows have many symbols, or are long and much repeated."""
    rnd = np.random.default_rng(2)
    x = {name: rnd.random(n) for name in quality.RATIOS}
    bad = (x["symbols_a_word"] > 0.8) | ((x["repeated_share"] > 0.7) & (x["words"] > 0.5))
    return x, bad


def test_rules_find_what_makes_rows_bad():
    x, bad = made()
    rules = quality.learn(x, bad)
    hit = np.zeros(len(bad), dtype=bool)
    for rule in rules:
        hit[quality._covered(rule, x, np.arange(len(bad)))] = True
    assert (bad & hit).sum() > 0.9 * bad.sum()
    assert (~bad & hit).sum() < 0.02 * len(bad)


def test_nothing_to_learn_from():
    x, bad = made(300)
    assert quality.learn(x, np.zeros(300, dtype=bool)) == []
    noise = np.random.default_rng(9).random(300) < 0.3
    rules = quality.learn(x, noise)
    assert sum(len(quality._covered(r, x, np.arange(300))) for r in rules) < 30


def test_list_is_one_expression_in_order(spark):
    rules = [(quality.Condition("words", True, 10.0), quality.Condition("symbols_a_word", True, 0.5)),
             (quality.Condition("words", False, 2.0),)]
    rows = [(20, 15), (20, 1), (1, 0), (0, 0)]
    df = spark.createDataFrame(rows, "n_words long, n_symbols long")
    assert [r[0] for r in df.select(quality.rejects(rules)).collect()] == [0, None, 1, 1]
    assert df.select(quality.rejects([])).first()[0] is None
    assert str(rules[0][0]) == "words > 10"


def test_judging_a_table(spark, documents):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good + f" end{i}") for i in range(60)] + [(100 + i, "## $$ %% " * 30 + f"x{i}") for i in range(60)]
    rows += [(200, None), (201, ""), (202, "few words"), (203, "## " + good), (203, "## " + good), (None, good)]
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)] + [(None, 0, 0), (5, None, 1)],
        "doc_id long, quality int, toxic int",
    )
    docs = documents(rows)
    judged = {}
    for r in quality.judge(docs, labels).collect():
        judged.setdefault(r.doc_id, []).append((r.base_failed, r.kept))
    assert judged[200] == judged[201] == judged[202] == [(True, False)]
    assert judged[203] == [(False, True)] * 2 and judged[None] == [(False, True)]
    assert all(judged[i] == [(False, True)] for i in range(60))
    assert not any(kept for i in range(60) for _, kept in judged[100 + i])
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 60 + 2 + 1


def test_no_labels_and_no_rows(spark, documents, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(documents(["a " * 10]), labels).first().kept is False
    assert quality.judge(empty, labels).collect() == []
