import gc
import random
import weakref
from collections import Counter

import numpy as np
import pytest

from headway.llm import suffixes


def brute(texts, depth):
    contents = [(t or "").encode() for t in texts]
    n = Counter(c[i : i + depth] for c in contents for i in range(len(c) - depth + 1))
    out = []
    for c in contents:
        gone = np.zeros(len(c) + 1, dtype=bool)
        for i in range(len(c) - depth + 1):
            if n[c[i : i + depth]] > 1:
                gone[i : i + depth] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(c), int(gone.sum()), runs, bytes(b for b, g in zip(c, gone, strict=False) if not g)))
    return out


def texts(depth):
    rnd = random.Random(depth)
    word = lambda: "".join(rnd.choices("abcdefgé", k=rnd.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    a, b, c = prose(300), prose(120), prose(250)
    return [
        None, "", "short", a, a, prose(50) + b + prose(30), prose(90) + b, b[:depth], b[3 : depth + 2],
        c + prose(5) + c, "ab" * depth, "z" * (3 * depth), a[: len(a) // 2] + "#" + a[len(a) // 2 :],
        c[:40] + "!" + c[41:], prose(400), "é" * depth, "xé" + "é" * depth,
    ]


@pytest.mark.parametrize("depth", [400, 128, 90])
def test_against_brute_force(documents, depth, monkeypatch):
    # Small parts, so that long texts are cut.
    monkeypatch.setattr(suffixes, "PART", 700)
    rows = texts(depth)
    got = suffixes.remove_repeats(documents(rows), depth).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got] == brute(rows, depth)


def test_repeated_rows_and_null_ids_lose_their_windows(documents):
    text = "".join(random.Random(5).choices("abcdefghij", k=900))
    rows = suffixes.remove_repeats(documents([(1, text), (1, text), (None, "x" + text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.kept) for r in rows) == [
        (0, 900, b"x"), (1, 900, b""), (1, 900, b""),
    ]


def test_what_is_left_is_written_by_the_operator_itself(documents, capsys):
    # Whoever writes the result would hand whole texts to Python in batches of Spark's own size.
    kept = suffixes.remove_repeats(documents(["a" * 900, "b" * 500]))
    kept.explain()
    assert "MapInArrow" not in capsys.readouterr().out
    assert sorted((r.n_bytes, r.n_removed) for r in kept.collect()) == [(500, 500), (900, 900)]


def test_stripping_keeps_other_columns(documents):
    text = "".join(random.Random(6).choices("abcdé", k=900))
    docs = documents(["one " + text, "two " + text, None, "three"])
    out = suffixes.strip_repeats(docs)
    assert out.columns == docs.columns
    assert sorted(r.text or "" for r in out.collect()) == ["", "one", "three", "two"]


def test_empty_table(empty):
    assert suffixes.remove_repeats(empty).collect() == []
    assert suffixes.strip_repeats(empty).collect() == []


def test_names_of_a_buffer_go_with_it():
    gc.disable()
    try:
        names = suffixes.Names(400)
        short = names.short(np.arange(2000, dtype=np.uint8), 0)
        names.long(short, np.arange(10), 0)
        held = weakref.ref(short)
        del short
        assert held() is None
    finally:
        gc.enable()


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    want = [values[i : i + 7].min() for i in range(44)]
    assert suffixes.sliding_min(values, 7).tolist() == want
