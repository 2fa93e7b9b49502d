"""URL filters: domain rules first, then word segmentation of hosts and naive Bayes.

Names such as ``cheapbooksonline`` are split into their likeliest words by Viterbi search under a
unigram model of the words that the pages themselves use. The words of host and path then score
under a multinomial naive Bayes model. Its labels come from the URLs: one with a seed word of
unwanted sites among its host's words counts as blocked, any other as allowed, so that words that
go along with seed words are learned from all pages.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.stage import most_frequent, slices, staged

# Words of the unigram model and tokens of the classifier that are broadcast, the most frequent
# ones. Rarer ones count alike, but stay in tables that are joined.
UNIGRAMS = 50_000
TOKENS = 50_000
LONGEST_WORD = 20

#: Words in names of unwanted sites.
SEEDS = (
    "adult", "bet", "bets", "betting", "casino", "cheap", "escort", "farm", "free", "gamble",
    "loan", "loans", "pills", "poker", "porn", "sex", "spam", "track", "viagra", "win", "xxx",
)
# Seeds that by themselves label a host; the others do so only together with another seed.
_SURE = frozenset(
    {"adult", "casino", "escort", "gamble", "pills", "poker", "porn", "sex", "spam", "viagra", "xxx"}
)


@dataclass(frozen=True)
class Rule:
    """A verdict for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return f"{self.host}{self.path}"


#: The rules of the query.
RULES = (
    Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty
    for a null URL or one without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """Number of the longest rule that fits, null if none does; of equals the first."""
    out = None
    order = sorted(range(len(rules)), key=lambda i: -len(str(rules[i])))
    for i in order:
        rule = rules[i]
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, i) if out is None else out.when(fits, i)
    return F.lit(None).cast("int") if out is None else out


_WORD = re.compile(r"[a-z]+")
_TAG = re.compile(r"<[^>]*>")


def _counted(batches: Iterator[pa.RecordBatch], column: str, words_of) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    for batch in slices(batches, column):
        for text in batch.column(column).to_pylist():
            counts.update(words_of(text or ""))
        if len(counts) > 200_000:
            yield rows()
            counts.clear()
    yield rows()


def _html_words(text: str) -> list[str]:
    return _WORD.findall(_TAG.sub(" ", text).lower())


@dataclass
class Unigrams:
    """Log probabilities of words: the frequent ones, a table (word, log) of all others, and the
    least of all."""

    logs: dict[str, float]
    rare: DataFrame
    least: float


def _beyond(counts: DataFrame, by: str, most: list) -> DataFrame:
    """The rows that ``most_frequent`` leaves out."""
    if not most:
        return counts.where(F.lit(False))
    last = most[-1]
    return counts.where((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col(by) > last[by])))


def unigrams(pages: DataFrame, size: int = UNIGRAMS) -> Unigrams:
    """Log probability of all words of all pages' texts and of SEEDS, which may be rare there.
    One-letter words are left out, as they would split anything."""
    counts = staged(
        pages.select("html")
        .mapInArrow(lambda b: _counted(b, "html", _html_words), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.length("word").between(2, LONGEST_WORD)),
        "words",
    )
    most = most_frequent(counts, ["word"], size).collect()
    n = {row["word"]: row["n"] for row in most}
    middling = sorted(n.values())[len(n) // 2] if n else 1
    of_all = counts.agg(F.sum("n").alias("total"), F.min("n").alias("least")).first()
    seeds = {r["word"]: r["n"] for r in counts.where(F.col("word").isin(*SEEDS)).collect()}
    total = of_all["total"] or 0
    for seed in SEEDS:
        n[seed] = max(n.get(seed, 0), middling)
        total += n[seed] - seeds.get(seed, 0)
    total = math.log(total)
    rare = _beyond(counts, "word", most).where(~F.col("word").isin(*SEEDS))
    return Unigrams(
        {word: math.log(count) - total for word, count in n.items()},
        rare.select("word", (F.log("n") - total).alias("log")),
        math.log(min(of_all["least"] or middling, middling)) - total,
    )


class Segmenter:
    """Splits names into words by Viterbi search."""

    def __init__(self, logs: dict[str, float], least: float | None = None):
        self.logs = logs
        self.least = (min(logs.values(), default=0.0) if least is None else least) - 4.0
        self.longest = max(map(len, logs), default=1)

    def split(self, name: str, rare: dict[str, float] | None = None) -> list[str]:
        """The likeliest words, also of ``rare`` ones; letters that no word covers stand together."""
        rare = rare or {}
        longest = max(self.longest, max(map(len, rare), default=1))
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            # An unknown letter costs more than any word.
            score, start = best[end - 1] + 2 * self.least, end - 1
            for begin in range(max(0, end - longest), end):
                piece = name[begin:end]
                log = self.logs.get(piece, rare.get(piece))
                if log is not None and best[begin] + log > score:
                    score, start = best[begin] + log, begin
            best.append(score)
            back.append(start)
        words, end, unknown = [], len(name), ""
        while end:
            word = name[back[end] : end]
            if word in self.logs or word in rare:
                if unknown:
                    words.append(unknown)
                    unknown = ""
                words.append(word)
            else:
                unknown = word + unknown
            end = back[end]
        if unknown:
            words.append(unknown)
        return words[::-1]


# Names that say nothing of a site.
_COMMON = frozenset({"www", "m", "http", "https", "html", "htm", "php", "index"})


def _labels(host: str) -> list[str]:
    """Names within a host's labels but the top-level domain."""
    names = re.split(r"[^a-z]+", host.rpartition(".")[0] or host)
    return [x for x in names if x and x not in _COMMON]


def _path_words(path: str) -> list[str]:
    return [f"/{w}" for w in _WORD.findall(path.lower()) if w not in _COMMON]


def host_words(hosts: DataFrame, model: Unigrams) -> DataFrame:
    """host, words of the distinct ``hosts``. Frequent words are looked up in tasks; every other
    piece of a label is joined with the table of rare words."""
    held = hosts.sparkSession.sparkContext.broadcast((model.logs, model.least))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, i, x) for h in batch.column(0).to_pylist() for i, x in enumerate(_labels(h))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_NAMED)],
                ["host", "at", "label"],
            )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, _ = held.value
        for batch in batches:
            for label in batch.column(0).to_pylist():
                own = {
                    label[a:b] for a in range(len(label))
                    for b in range(a + 2, min(len(label), a + LONGEST_WORD) + 1)
                } - logs.keys()
                if own:
                    yield pa.RecordBatch.from_pydict({"label": [label] * len(own), "word": list(own)})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(*held.value)
        for batch in batches:
            words = [
                segmenter.split(label, {x["word"]: x["log"] for x in rare or ()})
                for label, rare in zip(
                    batch.column("label").to_pylist(), batch.column("rare").to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(words, pa.list_(pa.string()))], ["label", "words"]
            )

    names = staged(
        hosts.select("host").distinct().mapInArrow(named, "host string, at int, label string"), "labels"
    )
    labels = names.select("label").distinct()
    rare = (
        labels.mapInArrow(pieces, "label string, word string").join(model.rare, "word")
        .groupBy("label").agg(F.collect_list(F.struct("word", "log")).alias("rare"))
    )
    words = labels.join(rare, "label", "left").select("label", "rare").mapInArrow(
        split, "label string, words array<string>"
    )
    listed = names.join(words, "label").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("at", "words"))).alias("list")
    )
    return listed.select("host", F.flatten(F.transform("list", lambda x: x["words"])).alias("words"))


_NAMED = (pa.string(), pa.int32(), pa.string())


def seeded(words: list[str], seeds: tuple[str, ...] = SEEDS) -> bool:
    own = set(words) & set(seeds)
    return bool(own & _SURE) or len(own) > 1


@dataclass
class NaiveBayes:
    """Log odds for blocking: those of the classes, of frequent tokens, and a table (token, odds)
    of all others."""

    prior: float
    odds: dict[str, float]
    rare: DataFrame


def train(urls: DataFrame, size: int = TOKENS) -> NaiveBayes:
    """Counts tokens by class over all rows of words and path, smoothed by one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, bool]] = Counter()

        def rows():
            keys = list(counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.bool_()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["token", "bad", "n"],
            )

        for batch in batches:
            for words, path in zip(
                batch.column("words").to_pylist(), batch.column("path").to_pylist(), strict=True
            ):
                bad = seeded(words)
                # The empty token counts the rows.
                counts.update((t, bad) for t in ["", *words, *_path_words(path)])
            if len(counts) > 200_000:
                yield rows()
                counts.clear()
        yield rows()

    by_token = staged(
        urls.select("words", "path").mapInArrow(count, "token string, bad boolean, n long")
        .groupBy("token").agg(
            F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(~F.col("bad"), F.col("n")).otherwise(0)).alias("good"),
        )
        .withColumn("n", F.col("bad") + F.col("good")),
        "tokens",
    )
    rows = by_token.where("token = ''").first()
    by_token = by_token.where("token != ''")
    most = most_frequent(by_token, ["token"], size).collect()
    if not rows or not rows["bad"]:
        # Nothing to learn a block from.
        none = by_token.where(F.lit(False)).select("token", F.lit(0.0).alias("odds"))
        return NaiveBayes(-1.0, {}, none)
    sums = by_token.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("n")).first()
    bad, good = ((sums[x] or 0) + sums["n"] + 1 for x in ("bad", "good"))
    odds = F.log((F.col("bad") + 1) / bad) - F.log((F.col("good") + 1) / good)
    return NaiveBayes(
        math.log(rows["bad"] + 1) - math.log(rows["good"] + 1),
        {
            r["token"]: math.log((r["bad"] + 1) / bad) - math.log((r["good"] + 1) / good)
            for r in most
        },
        _beyond(by_token, "token", most).select("token", odds.alias("odds")),
    )


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, words_held: int = UNIGRAMS,
    tokens_held: int = TOKENS,
) -> DataFrame:
    """All rows of ``pages`` (page_id, url, html) as page_id, host, path, rule (the rule that
    decides, else null), verdict (allow or block), words (of the host) and score (log odds for
    blocking). How many words and tokens are held in tasks changes no result. A null URL has an empty host and path and no words; it gets the likelier class."""
    # Numbered when written, so that a task run again finds the same numbers.
    urls = staged(
        pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .withColumn("row", F.monotonically_increasing_id()),
        "urls",
    )
    words = host_words(urls.select("host"), unigrams(pages, words_held))
    none = F.array().cast("array<string>")
    parts = staged(
        urls.join(words, "host", "left").withColumn("words", F.coalesce("words", none)), "parts"
    )
    model = train(parts, tokens_held)
    held = pages.sparkSession.sparkContext.broadcast((model.prior, model.odds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, odds = held.value
        for batch in batches:
            scores, others = [], []
            for words, path in zip(
                batch.column("words").to_pylist(), batch.column("path").to_pylist(), strict=True
            ):
                own = [*words, *_path_words(path)]
                scores.append(prior + sum(odds.get(t, 0.0) for t in own))
                others.append([t for t in own if t not in odds])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores, pa.float64()), pa.array(others, pa.list_(pa.string()))],
                ["row", "held", "others"],
            )

    part = staged(
        parts.select("row", "words", "path")
        .mapInArrow(score, "row long, held double, others array<string>"),
        "scores",
    )
    # Sorted before they are added, so that a sum does not depend on the order of a shuffle.
    rare = (
        part.select("row", F.explode("others").alias("token")).join(model.rare, "token")
        .groupBy("row").agg(F.array_sort(F.collect_list("odds")).alias("odds"))
        .select("row", F.aggregate("odds", F.lit(0.0), lambda s, x: s + x).alias("more"))
    )
    scored = (
        parts.join(part.select("row", "held"), "row").join(rare, "row", "left")
        .withColumn("score", F.col("held") + F.coalesce("more", F.lit(0.0)))
    )
    number = ruled(rules, F.col("host"), F.col("path"))
    names = F.array(*[F.lit(str(r)) for r in rules]) if rules else F.array(F.lit(""))
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array(F.lit(""))
    learned = F.when(F.col("score") > 0, "block").otherwise("allow")
    return scored.withColumn("n", number).select(
        "page_id", "host", "path",
        F.get(names, F.col("n")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("n")), learned).alias("verdict"),
        "words", "score",
    )
