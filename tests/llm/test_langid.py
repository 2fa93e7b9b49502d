import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import langid


def brute_model(words):
    """Interpolated Kneser-Ney from its definition, over words between pads."""
    counts = {n: Counter() for n in range(1, langid.ORDER + 1)}
    text = ["\x01" * (langid.ORDER - 1) + w + "\x02" for w in words]
    for t in text:
        for i in range(langid.ORDER - 1, len(t)):
            counts[langid.ORDER][t[i - langid.ORDER + 1 : i + 1]] += 1
    tokens = dict(counts[langid.ORDER])
    for n in range(langid.ORDER - 1, 0, -1):
        raw, types = Counter(), Counter()
        for gram, c in tokens.items():
            raw[gram[1:]] += c
            types[gram[1:]] += 1
        tokens = dict(raw)
        for gram in raw:
            counts[n][gram] = raw[gram] if n > 1 and gram[0] == "\x01" else types[gram]
    alphabet = len(counts[1]) + 1
    totals = {n: defaultdict(float) for n in counts}
    kinds = {n: Counter() for n in counts}
    discount = {}
    for n, c in counts.items():
        for gram, value in c.items():
            totals[n][gram[:-1]] += value
            kinds[n][gram[:-1]] += 1
        once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
        discount[n] = min(0.95, max(0.1, once / max(once + 2 * twice, 1)))

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / alphabet
        lower, total = p(gram[1:]), totals[n][gram[:-1]]
        if not total:
            return lower
        return (max(counts[n][gram] - discount[n], 0) + discount[n] * kinds[n][gram[:-1]] * lower) / total

    return p


def model_of(words):
    grams, n = np.unique(langid._symbols(words)[0], return_counts=True)
    return grams, n


def test_probabilities_against_the_definition():
    rnd = random.Random(3)
    by = {lang: ["".join(rnd.choices(letters, k=rnd.randint(1, 6))) for _ in range(80)]
          for lang, letters in {"aa": "abcdé", "bb": "cdefg"}.items()}
    model = langid.build({lang: model_of(words) for lang, words in by.items()})
    asked = ["abc", "gfe", "zzz", "é", "cdcd"] + by["aa"][:10]
    for column, lang in enumerate(model.languages):
        p = brute_model(by[lang])
        for word in asked:
            grams, _, _ = langid._symbols([word])
            padded = "\x01" * (langid.ORDER - 1) + word + "\x02"
            want = [math.log(p(padded[i - 3 : i + 1])) for i in range(3, len(padded))]
            assert model.log_probability(grams)[:, column] == pytest.approx(want)


def test_probabilities_add_up_to_one():
    model = langid.build({"aa": model_of(["abab", "abba", "baab", "aaaa", "abc"])})
    for context in ("\x01\x01\x01", "\x01\x01a", "aba", "zzz"):
        key = sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(context))
        # Every symbol there is, and one that stands for all others.
        asked = np.array([key | ord(c) for c in "abc\x02?"], dtype=np.uint64)
        assert np.exp(model.log_probability(asked)).sum() == pytest.approx(1)


def texts_of(lang, n, rnd):
    syllables = {"xx": ["ka", "to", "mi", "ra"], "yy": ["schr", "ung", "ei", "lt"]}[lang]
    return [" ".join("".join(rnd.choices(syllables, k=rnd.randint(1, 3))) for _ in range(30)) for _ in range(n)]


def test_identification(spark, documents):
    rnd = random.Random(1)
    rows = [(i, t, "xx", "s", 0) for i, t in enumerate(texts_of("xx", 60, rnd))]
    rows += [(100 + i, t, "yy", "s", 0) for i, t in enumerate(texts_of("yy", 60, rnd))]
    rows += [(500, None, "xx", "s", 0), (501, "text", None, "s", 0), (None, "ka to", "xx", "s", 0)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.learn(labelled)
    assert model.languages == ["xx", "yy"]
    asked = [None, "", "123 ?!", *texts_of("xx", 3, rnd), *texts_of("yy", 3, rnd), "日本", "x" * 200_000, "ka", "ka"]
    got = {r.doc_id: r for r in langid.identify(documents(asked), model).collect()}
    langs = [got[i].lang_pred for i in range(len(asked))]
    assert langs[:9] == ["und"] * 3 + ["xx"] * 3 + ["yy"] * 3
    assert set(langs[9:11]) <= {"xx", "yy"} and langs[11:] == ["xx", "xx"]
    assert all(0 <= got[i].score <= 1 for i in range(len(asked))) and got[0].score == 0
    assert got[9].rejected and not any(got[i].rejected for i in range(3))


def test_without_labels_every_text_is_unknown(documents, empty):
    assert langid.learn(empty) is None
    assert langid.identify(documents(["some text"]), None).first().lang_pred == "und"
    assert langid.identify(empty, None).collect() == []


def test_held_out_by_checksum(spark):
    got = spark.range(50).select(langid.held_out(F.col("id"))).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)]
