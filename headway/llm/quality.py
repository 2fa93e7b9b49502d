"""Quality rules: fixed limits, and a decision list learned from labelled statistics.

Each text gets a row of statistics. Sequential covering learns the list on labelled rows: a rule,
a conjunction of thresholds on statistics, grows on two thirds of the rows until it covers no good
document, is pruned on the other third, and is kept while it is precise there; the rows it covers
leave, and the next rule is learned on the rest. The list is one Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.stage import SLICE_BYTES, free_names, slices, staged
from headway.llm.words import SPACE, WordSplitter, shingles

# Labelled rows that rules are learned from, at most: those of smallest hash.
SAMPLE_ROWS = 20_000
MAX_RULES = 24
MAX_CONDITIONS = 4
# Thresholds tried for each statistic.
CUTS = 48
# Least precision of a rule on rows it was not grown on, and least rejects it covers there.
PRECISION = 0.97
LEAST_COVERED = 3
MIN_WORDS = 50
MAX_REPEATED = 50

SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_digits", "n_marks", "n_distinct_words",
)
# Statistics that rules may use: counts by words, by word characters, or as they are.
RATIOS = {
    "words": ("n_words", None),
    "chars_a_word": ("word_chars", "n_words"),
    "symbols_a_word": ("n_symbols", "n_words"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "dup_lines_share": ("n_dup_lines", "n_lines"),
    "words_a_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_a_word": ("n_marks", "n_words"),
}


def _byte_set(values: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


def _counter():
    """Counts of texts: a function from their bytes to an array for each of COUNTS."""
    wanted = {
        "word_chars": ~SPACE & ~_byte_set(bytes(range(0x80, 0xC0))),
        "n_symbols": _byte_set(SYMBOLS),
        "n_upper": _byte_set(bytes(range(65, 91))),
        "n_digits": _byte_set(b"0123456789"),
        "n_marks": _byte_set(b"!?"),
    }

    splitter = WordSplitter()

    def counts(texts: list[bytes]) -> dict[str, np.ndarray]:
        n = len(texts)
        words = splitter.split(texts)
        out = {"n_words": np.diff(words.first)}
        ends = np.r_[words.offsets[1:], len(words.raw)]
        for name, table in wanted.items():
            sums = np.r_[0, np.cumsum(table[words.raw], dtype=np.int64)]
            out[name] = sums[ends] - sums[words.offsets]
        lines = [[x for x in t.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")] for t in texts]
        out["n_lines"] = np.array([len(x) for x in lines], dtype=np.int64)
        out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64)
        salt = np.uint64(0x9FB21C651E98DF25)
        key = words.hash + words.text.astype(np.uint64) * salt
        first = np.unique(key, return_index=True)[1]
        out["n_distinct_words"] = np.bincount(words.text[first], minlength=n)
        # Windows of three words: equal ones within a text, by 64-bit hashes.
        hashes, text = shingles(words, 3)
        at = np.arange(len(text)) - np.searchsorted(text, text) + words.first[:-1][text]
        whole = out["n_words"][text] >= 3
        hashes, text, at = hashes[whole], text[whole], at[whole]
        _, kind, count = np.unique(
            hashes + text.astype(np.uint64) * salt, return_inverse=True, return_counts=True
        )
        again = at[count[kind] > 1]
        covered = np.zeros(len(words.text) + 2, dtype=bool)
        for j in range(3):
            covered[again + j] = True
        out["n_repeat_words"] = np.bincount(
            words.text[covered[: len(words.text)]], minlength=n
        )
        return out

    return counts


def _measurer():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counter()
        for batch in slices(batches, "content"):
            out = counts(batch.column("content").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key")]
                + [pa.array(out[name], pa.int64()) for name in COUNTS],
                ["doc_id", "text_key", *COUNTS],
            )

    return run


def measure(docs: DataFrame) -> DataFrame:
    """Counts of all rows of ``docs`` (doc_id and text, other columns are left out): doc_id,
    text_key (a hash of the text) and COUNTS. A null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.coalesce("text", F.lit("")).cast("binary").alias("content"),
    ).mapInArrow(
        _measurer(), "doc_id long, text_key long, " + ", ".join(f"{c} long" for c in COUNTS)
    )


def _count(name: str, of: str | None) -> Column:
    return F.col(of)[name] if of else F.col(name)


def ratio(name: str, of: str | None = None) -> Column:
    """A statistic of RATIOS; 0 for a text without what it is divided by. ``of`` is the column that
    holds the counts, if they are not columns themselves."""
    over, under = RATIOS[name]
    if under is None:
        return _count(over, of).cast("double")
    return F.when(_count(under, of) > 0, _count(over, of) / _count(under, of)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        value = x[self.statistic]
        return value > self.cut if self.above else value <= self.cut

    def column(self, of: str | None = None) -> Column:
        value = ratio(self.statistic, of)
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, x: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for condition in rule:
        rows = rows[condition.holds(x)[rows]]
    return rows


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """Adds the condition of highest information gain until no good row is covered."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS and (~bad[rows]).any():
        p, n = bad[rows].sum(), (~bad[rows]).sum()
        base = np.log2(p / (p + n))
        best, chosen = 1e-9, None
        for name in RATIOS:
            values = x[name][rows]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 2)[1:-1]))
            order = np.sort(values[bad[rows]]), np.sort(values[~bad[rows]])
            below_p, below_n = (np.searchsorted(o, cuts, side="right") for o in order)
            for above, ps, ns in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
                share = np.log2(np.maximum(ps, 1e-9) / np.maximum(ps + ns, 1e-9))
                gain = np.where(ps > 0, ps * (share - base), 0)
                at = int(gain.argmax())
                if gain[at] > best:
                    best, chosen = gain[at], Condition(name, above, float(cuts[at]))
        if chosen is None:
            break
        rule.append(chosen)
        rows = _covered((chosen,), x, rows)
    return tuple(rule)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """The beginning of the rule that is worth most on rows it was not grown on; of equals the
    longest."""
    def worth(k: int) -> float:
        hit = _covered(rule[:k], x, rows)
        return (2 * bad[hit].sum() - len(hit)) / len(hit) if len(hit) else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), k))] if rule else rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = PRECISION) -> list[Rule]:
    """The decision list: rules that reject, tried in order. No bad rows, no rules."""
    order = np.random.default_rng(0).permutation(len(bad))
    rules: list[Rule] = []
    rows = order
    while len(rules) < MAX_RULES:
        grow, prune = rows[np.arange(len(rows)) % 3 > 0], rows[np.arange(len(rows)) % 3 == 0]
        if not bad[grow].any():
            break
        rule = _prune(_grow(x, bad, grow), x, bad, prune)
        hit = _covered(rule, x, prune) if rule else prune[:0]
        if bad[hit].sum() < LEAST_COVERED or bad[hit].mean() < precision:
            break
        rules.append(rule)
        rows = rows[~np.isin(rows, _covered(rule, x, rows))]
    return rules


def rejects(rules: list[Rule], of: str | None = None) -> Column:
    """The list as one conditional expression: the number of the first rule that holds, or null."""
    out = None
    for number, rule in enumerate(rules):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(of)
        out = F.when(holds, number) if out is None else out.when(holds, number)
    return F.lit(None).cast("int") if out is None else out


def _chosen(labels: DataFrame, sample_rows: int) -> DataFrame:
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "quality"
    ).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id", "quality").limit(sample_rows)


def failed(of: str | None = None) -> Column:
    """Whether counts are beyond the fixed limits."""
    n_words = _count("n_words", of)
    return (n_words < MIN_WORDS) | (100 * _count("n_repeat_words", of) > MAX_REPEATED * n_words)


def fit(measured: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from ``labels`` (doc_id, quality with 0 for a document to reject) of measured texts.
    Rows with a null label or doc_id are left out."""
    known = _chosen(labels, sample_rows).join(measured, "doc_id").select(
        "doc_id", "text_key", (F.col("quality") == 0).alias("bad"), *[ratio(r).alias(r) for r in RATIOS]
    )
    # Pairs of a repeated document and its labels may be more than either.
    rows = known.orderBy("doc_id", "text_key", "bad").limit(2 * sample_rows).toPandas()
    if not len(rows):
        return []
    return learn({r: rows[r].to_numpy() for r in RATIOS}, rows["bad"].to_numpy())


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All rows of ``docs`` with their counts, base_failed, rule (number of the learned rule that
    rejects, else null) and kept. A null or empty text has no words and fails the fixed limits;
    without labels only those hold; repeated rows are judged alike."""
    measured = staged(measure(docs), "measured")
    return (
        measured.withColumn("base_failed", failed())
        .withColumn("rule", rejects(fit(measured, labels, sample_rows)))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def keep(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of ``docs`` that are kept, with all their columns; as :func:`judge` has it. Rules are
    learned first, on the labelled texts alone; the rest is then measured and filtered in one go."""
    chosen = _chosen(labels, sample_rows)
    # At most ``sample_rows`` rows of an id.
    ids = F.broadcast(chosen.select("doc_id").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rules = fit(staged(measure(texts.join(ids, "doc_id", "left_semi")), "labelled"), labels, sample_rows)
    # The counts come back beside the rows, which neither leave the JVM nor are shuffled.
    struct = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])

    @F.pandas_udf(struct)
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = _counter()
        for part in parts:
            sizes = np.cumsum([len(x or "") for x in part])
            cuts = np.unique(np.r_[0, np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1, len(part)])
            yield pd.concat([
                pd.DataFrame(counts([(x or "").encode() for x in part.iloc[a:b]]))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ] or [pd.DataFrame({name: [] for name in COUNTS}, dtype="int64")])

    [own] = free_names(docs, "counts")
    measured = docs.withColumn(own, counted.asNondeterministic()("text"))
    good = ~failed(own) & rejects(rules, own).isNull()
    return measured.where(good).select(*docs.columns)
