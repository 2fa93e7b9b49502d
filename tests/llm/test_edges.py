"""Rows that every operator must bear: nulls, repeats, long texts, names that clash, no rows."""

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import forest, langid, quality, secrets, suffixes

NAMES = (
    "__doc __key __spans __rows doc rows spans content text_key n_words kept rule node class label tree "
    "terms n prefix c0 c1 low high draw rank lang_pred"
).split()
PROSE = " ".join(f"word{i % 97} and other{i % 89}" for i in range(90))
TEXTS = [
    (1, None), (2, ""), (3, "x"), (4, PROSE), (4, PROSE), (5, PROSE + " with an end of its own"), (None, PROSE),
    (6, "token = abcdef123456 " + PROSE), (None, None), (7, "é😀 " * 300),
]


def crowded(docs):
    """With columns whose names an operator may use itself."""
    return docs.select("*", *[F.lit(i).alias(name) for i, name in enumerate(NAMES)])


def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")


HELPERS = {
    "quality": lambda spark, docs: quality.keep(docs, labels(spark)),
    "forest": lambda spark, docs: forest.one_of_each(docs),
    "suffixes": lambda spark, docs: suffixes.strip_repeats(docs, 200),
    "secrets": lambda spark, docs: secrets.redact(docs),
}


@pytest.mark.parametrize("name", HELPERS)
def test_clashing_names_change_nothing(spark, documents, name):
    docs = documents(TEXTS)
    plain = HELPERS[name](spark, docs)
    wide = HELPERS[name](spark, crowded(docs))
    assert wide.columns == crowded(docs).columns
    rows = sorted(wide.collect(), key=str)
    assert {tuple(r)[len(docs.columns):] for r in rows} <= {tuple(range(len(NAMES)))}
    assert sorted(map(str, plain.collect())) == sorted(str(r) for r in wide.select(*docs.columns).collect())
    assert rows


def test_the_shipped_passages_are_found(spark, documents):
    """Passages of some 300 bytes, of more than 50 words, in texts that have nothing else alike."""
    passage = " ".join(f"w{i}x{i * 7 % 13}" for i in range(55))
    assert 250 < len(passage) < 400
    alone = [" ".join(f"own{d}n{i}" for i in range(120)) for d in range(4)]
    docs = documents([alone[0] + " " + passage, passage + " " + alone[1], alone[2], alone[3] + passage + "."])
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert got[2] == alone[2]
    assert all(passage[20:-20] not in text for text in got.values())
    assert got[0].strip() == alone[0] and got[1].strip() == alone[1]


@pytest.mark.parametrize("piece", ["token x ", "token", "token ", "secret=abc123 token ", "token abcdefghijklmnop1 "])
def test_sensitive_words_are_read_in_linear_time(piece):
    start = time.time()
    text = piece * (4_000_000 // len(piece))
    spans = secrets.base_spans(text)
    found = secrets.candidates(text, spans)
    assert time.time() - start < 30
    assert all(not (s < b and a < e) for a, b in found[:200] for s, _, e in spans[:2000])


def test_candidates_against_the_definition():
    import random
    import re

    rnd = random.Random(2)
    run = re.compile("[A-Za-z0-9+/_=-]{16,}")
    parts = ["token", "secret ", "a1b2c3d4e5f6g7h8i9", " ", "x" * 20, "password: abcdef99 ", "\n" * 30, "key_", "é", "api_key"]
    for _ in range(300):
        text = "".join(rnd.choices(parts, k=rnd.randint(1, 25)))
        spans = secrets.base_spans(text)
        every = set()
        for word in secrets.SENSITIVE.finditer(text):
            at = word.end()
            while (m := run.search(text, at)) and m.start() < word.end() + secrets.REACH:
                every.add((m.start(), m.end()))
                at = m.end()
        ends = {b for _, b in every}
        every = {f(s for s in every if s[1] == b) for b in ends for f in (min, max)}
        want = sorted((a, b) for a, b in every if not any(s < b and a < e for s, _, e in spans))
        assert secrets.candidates(text, spans) == want


def test_language_sample_is_bounded_and_counts_copies_once(spark, documents, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 40)
    texts = [(i, f"ab{i} cd ef") for i in range(300)] + [(900, "hot text")] * 500
    sample = langid._sample(documents(texts)).collect()
    assert len(sample) == 40 and sum(r.text == "hot text" for r in sample) <= 1
    assert sum(r.calibrates for r in sample) == 8
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 100)
    few = langid._sample(documents(texts)).collect()
    assert 100 <= sum(len(r.text) for r in few) < 120


def test_letters_are_letters():
    assert langid.letters("½²") == [] and langid.letters("a²b_c1d") == ["a", "b", "c", "d"]
    assert langid.letters("X" * 500) == ["x" * 500]


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Driver with the package on its path alone, workers started without."""
    root = Path(__file__).resolve().parents[2]
    script = f"""
import sys, tempfile
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
         .getOrCreate())
spark.range(4).mapInArrow(lambda b: b, "id long").collect()
sys.path.insert(0, {str(root)!r})
from headway.llm import langid, maxscore, negatives, personal, secrets
rows = [(i, f"the house of word{{i}} and more a@b{{i}}.cc token k{{i}}" if i % 2 else f"das haus von wort{{i}}", "en" if i % 2 else "de", [0.1 * i, 1.0], i % 3)
        for i in range(40)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, embedding array<double>, label int")
print(langid.identify(docs, langid.learn(docs)).count(), personal.scan(docs).count(), secrets.redact(docs).count())
print(maxscore.search(docs, docs.selectExpr("doc_id AS item_id", "text").limit(3)).count() > 0)
from pyspark.sql import functions as F
print(negatives.mine(docs.withColumn("vec_id", F.col("doc_id")), F.col("vec_id") % 5 == 0).count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split() == ["40", "40", "40", "True", "True"]
