"""Language identification by interpolated Kneser-Ney character models.

A word is its letters in lower case between pads. Each language has a model of order ORDER over
the words of a bounded sample of labelled texts: highest-order counts as they are, lower orders by
the number of symbols an n-gram follows, each interpolated with the next lower one. The models of
all languages lie side by side in arrays sorted by n-gram, an n-gram being one 64-bit number, so
that one search gives the probabilities in every language. A text goes to the language in which
its cross-entropy per symbol is lowest; it is marked as rejected if that is higher than for all
but a few of the labelled texts of that language that the model did not see.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.stage import discard, slices, staged

ORDER = 4
# Labelled texts of a language that are looked at, those of smallest hash, and their bytes, of which
# the last text may pass the bound. Its model is learned from them but for every fifth, which
# calibrates rejection.
SAMPLE_TEXTS = 1_500
SAMPLE_BYTES = 32 << 20
CALIBRATES = 5
# Share of a language's own calibration texts that would be rejected.
REJECTED = 0.005
# Symbols of evidence that the score stands for.
EVIDENCE = 20
# Chunks whose scores a task remembers, and their characters.
KNOWN_WORDS = 300_000
KNOWN_CHARACTERS = 16 << 20
UNKNOWN = "und"
_PAD, _END = 1, 2
_LETTERS = re.compile(r"[^\W\d_]+")


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each symbol of each word, the word it belongs to, and sizes."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    # Symbols have 16 bits; code points beyond share those of the private use area.
    code = np.where(code > 0xFFFF, 0xE000 + code % 0x1900, code)
    padded = sizes + ORDER
    starts = np.cumsum(padded) - padded
    out = np.full(int(padded.sum()), _PAD, dtype=np.uint64)
    inside = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(starts + ORDER - 1, sizes) + inside] = code
    out[starts + padded - 1] = _END
    grams = np.zeros(len(out), dtype=np.uint64)
    for back in range(ORDER):
        grams[back:] |= out[: len(out) - back] << np.uint64(16 * back)
    own = np.ones(len(out), dtype=bool)
    for pad in range(ORDER - 1):
        own[starts + pad] = False
    return grams[own], np.repeat(np.arange(len(words)), sizes + 1), sizes + 1


def letters(chunk: str) -> list[str]:
    """Words of a white-space-delimited chunk: its runs of letters."""
    out = []
    for word in _LETTERS.findall(chunk.lower()):
        if word.isalpha():
            out.append(word)
        else:
            # Numbers such as a superscript two are neither digits to the pattern nor letters.
            out += "".join(c if c.isalpha() else " " for c in word).split()
    return out


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << (16 * n)) - 1)


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def _value(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    at, hit = _find(keys, asked)
    return np.where(hit, values[at], 0) if len(keys) else np.zeros(len(asked))


class Counts:
    """Counts of one language: for each order the n-grams, their (continuation) counts, their
    contexts with totals and numbers of different symbols, and the discount."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        order = np.argsort(grams)
        keys, tokens, adjusted = grams[order], n[order].astype(float), n[order].astype(float)
        self.orders = {}
        for length in range(ORDER, 0, -1):
            contexts, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            once, twice = (adjusted == 1).sum(), (adjusted == 2).sum()
            discount = min(0.95, max(0.1, once / max(once + 2 * twice, 1)))
            self.orders[length] = (
                keys, adjusted, contexts, np.bincount(at, weights=adjusted),
                np.bincount(at).astype(float), discount,
            )
            lower, at = np.unique(keys & _mask(length - 1), return_inverse=True)
            tokens = np.bincount(at, weights=tokens)
            types = np.bincount(at).astype(float)
            # An n-gram that starts with a pad follows nothing but pads; its tokens count.
            padded = (lower >> np.uint64(16 * max(length - 2, 0))) == _PAD
            keys, adjusted = lower, np.where(padded, tokens, types)


@dataclass
class Model:
    """For each order: n-grams, their log probabilities (a column for each language), contexts,
    and their log back-off weights. ``limits``: cross-entropy beyond which each rejects."""

    languages: list[str]
    keys: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    weights: dict[int, np.ndarray]
    unknown: np.ndarray
    limits: np.ndarray

    def log_probability(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural logs, a row for each n-gram."""
        if order == 0:
            return np.broadcast_to(self.unknown, (len(grams), len(self.languages)))
        at, hit = _find(self.keys[order], grams)
        out = np.empty((len(grams), len(self.languages)))
        out[hit] = self.logs[order][at[hit]]
        if not hit.all():
            rest = grams[~hit]
            lower = self.log_probability(rest & _mask(order - 1), order - 1).copy()
            at, known = _find(self.contexts[order], rest >> np.uint64(16))
            lower[known] += self.weights[order][at[known]]
            out[~hit] = lower
        return out


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Models of 4-gram counts by language."""
    languages = sorted(counts)
    each = [Counts(*counts[language]) for language in languages]
    alphabet = [len(c.orders[1][0]) + 1 for c in each]
    model = Model(languages, {}, {}, {}, {}, -np.log(np.array(alphabet, dtype=float)), np.array([]))
    for order in range(1, ORDER + 1):
        parts = [c.orders[order] for c in each]
        keys = np.unique(np.concatenate([p[0] for p in parts]))
        contexts = np.unique(np.concatenate([p[2] for p in parts]))
        weights = np.zeros((len(contexts), len(each)))
        lower = model.log_probability(keys & _mask(order - 1), order - 1)
        logs = np.empty((len(keys), len(each)))
        for column, (own, n, own_contexts, totals, types, discount) in enumerate(parts):
            count = _value(own, n, keys)
            total = _value(own_contexts, totals, keys >> np.uint64(16))
            kinds = _value(own_contexts, types, keys >> np.uint64(16))
            seen = total > 0
            below = np.exp(lower[:, column])
            with np.errstate(divide="ignore", invalid="ignore"):
                p = (np.maximum(count - discount, 0) + discount * kinds * below) / total
            logs[:, column] = np.log(np.where(seen, p, below))
            total = _value(own_contexts, totals, contexts)
            kinds = _value(own_contexts, types, contexts)
            weights[:, column] = np.log(np.where(total > 0, discount * kinds / np.maximum(total, 1), 1))
        model.keys[order], model.logs[order] = keys, logs
        model.contexts[order], model.weights[order] = contexts, weights
    return model


class Scorer:
    """Cross-entropies of texts; each distinct chunk between white space is scored once."""

    def __init__(self, model: Model):
        self.model, self.place, self.size = model, {}, 0
        self.rows = np.zeros((0, len(model.languages) + 1))

    def _learn(self, chunks: list[str]) -> None:
        words, owner = [], []
        for number, chunk in enumerate(chunks):
            for word in letters(chunk):
                words.append(word)
                owner.append(number)
        rows = np.zeros((len(chunks), len(self.model.languages) + 1))
        if words:
            grams, word, sizes = _symbols(words)
            logs = self.model.log_probability(grams)
            owner = np.array(owner)
            for column in range(logs.shape[1]):
                by_word = np.bincount(word, weights=logs[:, column], minlength=len(words))
                rows[:, column] = np.bincount(owner, weights=by_word, minlength=len(chunks))
            rows[:, -1] = np.bincount(owner, weights=sizes, minlength=len(chunks))
        start = len(self.place)
        self.size += sum(map(len, chunks))
        self.place.update(zip(chunks, range(start, start + len(chunks)), strict=True))
        self.rows = np.concatenate([self.rows[:start], rows])

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol in each language, and symbols, of each text."""
        split = [(text or "").split() for text in texts]
        every = set().union(*split)
        new = every.difference(self.place)
        if len(self.place) + len(new) > KNOWN_WORDS or self.size > KNOWN_CHARACTERS:
            self.place, self.size, new = {}, 0, every
        self._learn(sorted(new))
        sums = np.zeros((len(texts), len(self.model.languages) + 1))
        for number, chunks in enumerate(split):
            if chunks:
                at = np.fromiter(map(self.place.__getitem__, chunks), dtype=np.int64, count=len(chunks))
                sums[number] = self.rows[at].sum(axis=0)
        symbols = sums[:, -1]
        return -sums[:, :-1] / np.maximum(symbols, 1)[:, None], symbols


def held_out(doc_id: Column) -> Column:
    """Documents that take no part in learning: one in five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _sample(labelled: DataFrame) -> DataFrame:
    """lang, text and calibrates of the texts that are learned from."""
    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", F.xxhash64("text").alias("text_key"), "text",
    )
    key = ["lang", "doc_id", "text_key"]
    # A repeated row counts once, however often it is there.
    ids = staged(
        known.groupBy(*key).agg(F.max(F.octet_length("text")).cast("long").alias("n_bytes"))
        .withColumn("draw", F.xxhash64("doc_id", "text_key", F.lit(9))),
        "language-ids",
    )
    # Draws are uniform over 64 bits, so of a language with n texts those below SAMPLE_TEXTS / n of
    # the range are as many as are wanted; twice that are ranked, and the rest never meet.
    share = F.least(F.lit(1.0), F.lit(2.0 * SAMPLE_TEXTS) / F.col("n"))
    cuts = ids.groupBy("lang").agg(F.count("*").alias("n")).select(
        "lang", F.when(share < 1, share * 2.0**64 - 2.0**63).alias("cut")
    )
    # One row a language, of which the model has a column each; the ids of a language stay apart.
    near = ids.join(F.broadcast(cuts), "lang").where(F.col("cut").isNull() | (F.col("draw") <= F.col("cut")))
    window = W.partitionBy("lang").orderBy("draw", "doc_id", "text_key")
    before = F.coalesce(F.sum("n_bytes").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    chosen = (
        near.withColumn("rank", F.row_number().over(window)).withColumn("before", before)
        .where((F.col("rank") <= SAMPLE_TEXTS) & (F.col("before") < SAMPLE_BYTES))
    )
    # At most SAMPLE_TEXTS rows of an id and a number for each language; texts are not shuffled to
    # them, and copies of a row are told by their key.
    texts = known.join(F.broadcast(chosen.select(*key, "rank")), key).groupBy(*key, "rank").agg(
        F.first("text").alias("text")
    )
    out = staged(texts.select("lang", "text", (F.col("rank") % CALIBRATES == 0).alias("calibrates")), "language-sample")
    discard(ids)
    return out


def learn(labelled: DataFrame) -> Model | None:
    """The model of doc_id, text and lang, of which rows with a null are left out; None without
    rows. Ids, languages and sizes of all rows are looked at to choose the sample, which is
    bounded by texts and bytes for each language."""
    spark = labelled.sparkSession
    texts = _sample(labelled)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            by: dict[str, list[str]] = {}
            for lang, text in zip(
                batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                by.setdefault(lang, []).extend(letters(text))
            for lang, words in by.items():
                if words:
                    grams, n = np.unique(_symbols(words)[0], return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [lang] * len(n), "gram": grams.view(np.int64), "n": n}
                    )

    counted = (
        texts.where("NOT calibrates").mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    table = counted.toArrow()
    if not table.num_rows:
        return None
    langs = table.column("lang").to_numpy()
    grams = table.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    n = table.column("n").to_numpy()
    model = build({lang: (grams[langs == lang], n[langs == lang]) for lang in sorted(set(langs))})
    # Plain arrays: a broadcast does not carry the class to workers that lack this package.
    held = spark.sparkContext.broadcast(vars(model))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(**held.value))
        place = {lang: i for i, lang in enumerate(scorer.model.languages)}
        for batch in slices(batches, "text"):
            entropy, symbols = scorer.entropies(batch.column("text").to_pylist())
            langs = batch.column("lang").to_pylist()
            rows = [i for i, lang in enumerate(langs) if lang in place and symbols[i]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs[i] for i in rows], pa.string()),
                    pa.array([entropy[i, place[langs[i]]] for i in rows], pa.float64()),
                ],
                ["lang", "entropy"],
            )

    limits = {
        row["lang"]: row["limit"]
        for row in texts.where("calibrates").mapInArrow(measure, "lang string, entropy double")
        .groupBy("lang").agg(F.percentile("entropy", 1 - REJECTED).alias("limit")).collect()
    }
    model.limits = np.array([limits.get(lang, np.inf) for lang in model.languages])
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows of ``docs`` (doc_id and text, other columns are left out) as doc_id, lang_pred,
    score and rejected. A null text, or one without a letter, is ``und`` with score 0; without a
    model every text is. Of equally likely languages the first by name is taken."""
    held = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**held.value) if held.value else None
        scorer = Scorer(model) if model else None
        for batch in slices(batches, "text"):
            n = batch.num_rows
            lang, score, rejected = [UNKNOWN] * n, np.zeros(n), np.zeros(n, dtype=bool)
            if scorer:
                entropy, symbols = scorer.entropies(batch.column("text").to_pylist())
                best = entropy.argmin(axis=1)
                low = entropy[np.arange(n), best]
                odds = np.exp(-EVIDENCE * (entropy - low[:, None])).sum(axis=1)
                have = symbols > 0
                score = np.where(have, 1 / odds, 0.0)
                rejected = have & (low > model.limits[best])
                lang = [model.languages[b] if h else UNKNOWN for b, h in zip(best, have, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang), pa.array(score), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )
