import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import personal

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c))))
    return total % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [
        (m.start(), m.end(), k)
        for k, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


def with_luhn(digits):
    return next(digits + str(c) for c in range(10) if luhn(digits + str(c)))


def scanned(df):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in personal.scan(df).collect()}


def base_of(spans):
    return [s for s in spans if s[2] < len(personal.KINDS)]


def fragments(rnd):
    number = lambda n: "".join(rnd.choices("0123456789", k=n))
    return rnd.choice([
        "a.b@c.de", "x@y", "@z.z", "é@b.co", "😀", "日本@ex.jp", "%+-@a-b.c-d.e..f", f"u{number(2)}@m.example.com",
        ".".join(str(rnd.choice([0, 7, 255, 256, 999, "007", "000255"])) for _ in range(rnd.randint(2, 9))),
        with_luhn(number(rnd.randint(11, 18))), number(rnd.randint(1, 40)), "-".join(number(4) for _ in range(4)),
        "4 " * 15, f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", "+" + number(rnd.randint(2, 18)), "+1 ( . ) -",
        f"+4{number(8)}---", "++49 30 1234567", " ", "\n", ".", ", ", "(at)", "word", "\x00", "1.2.3.4.5.6.7.8",
    ])


def test_base_spans_against_python(documents):
    rnd = random.Random(11)
    texts = ["".join(fragments(rnd) + rnd.choice(["", " ", "", "x"]) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    got = scanned(documents([None, "", *texts]))
    for number, text in enumerate([None, "", *texts]):
        assert base_of(got[number]) == brute(text), text


def test_positions_beyond_a_block(documents, monkeypatch):
    monkeypatch.setattr(personal, "BLOCK", 4)
    text = " ".join(f"u{i}@m{i % 7}.example.com, 10.0.{i % 256}.1 é😀" for i in range(59))
    assert base_of(scanned(documents([text]))[0]) == brute(text)


@pytest.mark.parametrize("piece, n", [
    ("x", 2_000_000), ("1", 2_000_000), ("a.", 700_000), ("1 ", 700_000), ("+", 700_000), ("+1 ", 500_000),
    ("@", 700_000), ("1.", 700_000), ("a@", 500_000), ("( ", 500_000),
])
def test_long_texts_are_read_in_linear_time(documents, piece, n):
    start = time.time()
    text = piece * n + " end a@b.cc"
    got = scanned(documents([text]))[0]
    assert (len(text) - 6, len(text), 0) in got
    assert time.time() - start < 60


def test_domains_without_end_do_not_overflow(documents):
    text = "a@b" + ".c" * 100_000
    assert base_of(scanned(documents([text]))[0]) == [(0, len(text), 0)]


def test_no_rows_repeated_rows_null_ids_and_other_columns(documents, empty):
    assert personal.scan(empty).collect() == []
    docs = documents([(1, "a@b.cc"), (1, "a@b.cc"), (None, "c@d.ee"), (2, None)]).selectExpr(
        "*", "1 AS spans", "2 AS email", "3 AS proposals", "4 AS kind"
    )
    rows = personal.scan(docs).collect()
    assert sorted((r.doc_id or 0, [tuple(s) for s in r.spans]) for r in rows) == [
        (0, [(0, 6, 0)]), (1, [(0, 6, 0)]), (1, [(0, 6, 0)]), (2, [])
    ]


def corpus(n=600):
    """Phone numbers with and without their plus, beside order numbers that look alike."""
    rnd = random.Random(5)
    number = lambda: f"{rnd.randint(200, 989)}-{rnd.randint(200, 989)}-{rnd.randint(1000, 9999)}"
    texts = []
    for i in range(n):
        texts.append((i, f"please call me on +1 {number()} tomorrow"))
        # Refuted by the letter it is glued to, and with the context of an order.
        texts.append((n + i, f"see order no. K{number()} of part two"))
    wanted, others = [], []
    for i in range(60):
        texts.append((10_000 + i, f"please call us on {number()} today"))
        wanted.append(10_000 + i)
        texts.append((20_000 + i, f"see order no. {number()} of part two"))
        others.append(20_000 + i)
    return texts, wanted, others


def test_open_proposals_are_judged_by_context(documents):
    texts, wanted, others = corpus()
    got = scanned(documents(texts))
    by_id = dict(texts)
    kind = personal.ADDED.index("likely_phone") + len(personal.KINDS)
    hits = [i for i in wanted if any(s[2] == kind for s in got[i])]
    assert len(hits) >= 0.95 * len(wanted)
    for i in hits:
        [(a, b, _)] = got[i]
        assert re.fullmatch(r"[0-9]{3}-[0-9]{3}-[0-9]{4}", by_id[i][a:b])
    assert sum(any(s[2] == kind for s in got[i]) for i in others) <= 0.05 * len(others)
    assert all(base_of(got[i]) == brute(t) for i, t in texts)


def test_without_known_proposals_nothing_is_added(documents):
    got = scanned(documents([f"call 555-010-{i:04d}" for i in range(50)]))
    assert all(spans == [] for spans in got.values())


def test_thresholds_hold_on_what_was_kept_out():
    rnd = np.random.default_rng(3)
    n = 6000
    x = np.zeros((n, len(personal.FEATURES)), dtype=int)
    x[:, 0] = rnd.integers(0, 2, n)
    for f in range(1, len(personal.FEATURES)):
        x[:, f] = rnd.integers(0, 8, n)
    # Kind 0 follows from two features; kind 1 is a matter of luck.
    positive = np.where(x[:, 0] == 0, (x[:, 3] > 4) & (x[:, 8] <= 2), rnd.random(n) < 0.4)
    calibrates = rnd.random(n) < 0.2
    trees = personal.grow(x, positive, np.ones(n), calibrates)
    assert trees.thresholds[1] is None and trees.thresholds[2] is None
    score = trees.start + sum(personal._value(t, x) for t in trees.trees)
    held = calibrates & (x[:, 0] == 0)
    chosen = held & (score >= trees.thresholds[0])
    assert positive[chosen].mean() >= personal.PRECISION
    assert positive[chosen].sum() >= 0.95 * positive[held].sum()


def test_the_expression_is_the_trees(spark):
    rnd = np.random.default_rng(9)
    x = rnd.integers(0, 6, (500, len(personal.FEATURES)))
    x[:, 0] = rnd.integers(0, 4, 500)
    trees = personal.grow(x, (x[:, 2] > x[:, 5]), np.ones(500), rnd.random(500) < 0.3)
    df = spark.createDataFrame([tuple(map(int, row)) for row in x], list(personal.FEATURES))
    got = df.select(trees.score({name: F.col(name) for name in personal.FEATURES}).alias("s")).collect()
    want = trees.start + sum(personal._value(t, x) for t in trees.trees)
    assert np.allclose([r.s for r in got], want)


def test_no_python_on_the_main_path(documents, capsys):
    personal.scan(documents(["a@b.cc"])).explain()
    plan = capsys.readouterr().out
    personal.propose(documents(["a@b.cc"])).explain()
    assert not re.search("Python|Arrow|Pandas", plan + capsys.readouterr().out)


def test_all_known_proposals_are_learned_from(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(personal, "grow", lambda x, positive, n, calibrates: seen.append((x, positive, n, calibrates)))
    one = F.struct(
        F.col("id").cast("int").alias("start"), F.col("id").cast("int").alias("end"),
        (F.col("id") % 3 - 1).cast("int").alias("known"), (F.col("id") % 5 == 0).alias("calibrates"),
        *[F.lit(n).cast("int").alias(name) for n, name in enumerate(personal.FEATURES)],
    )
    found = spark.range(45_000).select(F.col("id").alias("text_key"), F.array(one, one).alias("proposals"))
    personal.learn(found)
    [(x, positive, n, calibrates)] = seen
    assert x.tolist() == [list(range(len(personal.FEATURES)))] * 4
    assert n.sum() == 60_000 and n[positive].sum() == 30_000 and n[calibrates].sum() == 12_000
