"""Personal data: proposed by loose patterns, judged by gradient-boosted trees; SQL functions only.

Fixed patterns give the base spans of emails, IP addresses, cards and phone numbers. For each kind a
generator proposes more: other separators, bracketed dots, numbers without a country code. Proposals
overlap base spans and each other. Some of them are known: those that hold a base span are positive,
those that a check of their kind refutes (a failing Luhn sum, a part above 255, a domain without a
dot, a date) negative. On these, boosted trees learn from format and context, without the marks by
which proposals are known. The rest, which are open, become spans if their score reaches their
kind's threshold, which is calibrated on known proposals kept out of training.

Everything that touches the corpus is columns: patterns, positions, features, and the trees, which
become conditional expressions. Only counts of equal feature rows, which hold small whole numbers, come
to the driver, where the trees are grown.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.stage import staged

KINDS = ("email", "ip", "card", "phone")
# Kinds of the spans that the trees add.
ADDED = tuple(f"likely_{kind}" for kind in KINDS)

# All known proposals are learned from; one text in FOLDS of them calibrates.
FOLDS = 5
TREES, DEPTH, RATE, SMOOTHING = 24, 3, 0.3, 1.0
# Of the known proposals at or above a threshold, so many must be positive, one more negative
# assumed.
PRECISION = 0.95
# Code points of context on either side, up to the next match.
CONTEXT = 32
# Lengths summed one after another; more go by blocks of as many.
BLOCK = 512

# Java patterns of the contract's base. Possessive, and with a look back to where a run starts, so
# that a long run is read once; ``\G`` is the end of the match before.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for a base span.
HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]",
}
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"

_DOT = r"(?:\.| ?[\[({](?:\.|dot)[\])}] ?)"
_AT = r"(?:[@＠]| ?[\[({]at[\])}] ?)"
_WIDE = r"[\p{L}\p{N}._%+-]"
GENERATORS = {
    "email": rf"(?:\G|(?<!{_WIDE})){_WIDE}++{_AT}[\p{{L}}\p{{N}}-]++(?:{_DOT}[\p{{L}}\p{{N}}-]++)*+",
    "ip": rf"(?<![0-9.])[0-9]{{1,3}}+(?:(?:{_DOT}| \. )[0-9]{{1,3}}+){{3,5}}+",
    "card": r"(?<![0-9])[0-9](?:[ ._/·-]{0,2}[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9]{2,4}+\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}+\)?){1,4}+(?![0-9])",
}
PROPOSE_HINTS = {
    "email": r"[@＠]|[\[({]at[\])}]", "ip": r"[0-9][\[({]?[ .d]", "card": "[0-9]",
    "phone": "[0-9][ ./)-]{1,2}[(]?[0-9]",
}
# Words, in small letters, that speak for a kind, and that speak for some other number.
CUES = {
    "email": r"mail|contact|write|reach|\bfrom\b|\bto:",
    "ip": r"\bips?\b|\bhosts?\b|\bserver|\baddress|\blogin|\bclient|\bping\b",
    "card": r"\bcard|\bvisa\b|mastercard|\bcredit|\bdebit|\bpay|\bbill",
    "phone": r"\bphone|\btel\b|\btel\.|\bcall|\bmobile|\bfax\b|\bcell\b|\bring\b|\bdial",
}
AGAINST = (
    r"\bversion|\bv\.?\s*$|\brelease|\border|\binvoice|\bsku\b|\bpart\b|\bserial|\bisbn|\bchapter|\bsection|"
    r"\bpages?\b|\bsize|\btotal|\bhash|\bbuild|\bitem|\bmodel|\bref\b|#\s*$"
)
FEATURES = (
    "kind", "length", "digits", "letters", "groups", "last", "zero", "left", "right", "cue",
    "against", "bracket",
)
# Features that show a kind's proposals to be known, and so are not learned from: those that follow
# from the domain's dots, the number of parts and their size, and what a number is glued to.
HIDDEN = {
    "email": {"length", "letters", "groups", "last"}, "ip": {"length", "digits", "groups"},
    "card": set(), "phone": {"left", "right"},
}
POSITIVE, NEGATIVE, OPEN = 1, 0, -1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums(lengths: Column) -> Column:
    """Total and running sums of a short array."""
    start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("ends"))

    def add(done: Column, length: Column) -> Column:
        total = done["total"] + length
        return F.struct(total.alias("total"), F.concat(done["ends"], F.array(total)).alias("ends"))

    return F.aggregate(lengths, start, add)


def running(lengths: Column) -> Column:
    """Running sums of an array. An array grows by copying, so long ones are summed by blocks."""

    def over(blocks: Column) -> Column:
        def shifted(before: Column) -> Column:
            return F.flatten(F.transform(
                blocks,
                lambda b, i: F.transform(
                    b["ends"], lambda end: end + F.when(i > 0, before[F.greatest(i - 1, F.lit(0))]).otherwise(0)
                ),
            ))

        return let(_sums(F.transform(blocks, lambda b: b["total"]))["ends"], shifted)

    n_blocks = F.greatest(F.ceil(F.size(lengths) / BLOCK).cast("int"), F.lit(1))
    starts = F.sequence(F.lit(0), n_blocks - 1)
    return let(F.transform(starts, lambda i: _sums(F.slice(lengths, i * BLOCK + 1, BLOCK))), over)


def matches(text: Column, pattern: str, hint: str) -> Column:
    """Leftmost matches that do not overlap: start, end (code points), text, and what stands
    before and after, up to the next match."""

    def placed(cut: Column) -> Column:
        gaps, hits = cut["gaps"], cut["hits"]
        sizes = F.transform(hits, lambda hit, i: F.length(gaps[i]) + F.length(hit))
        return let(running(sizes), lambda ends: F.transform(
            hits,
            lambda hit, i: F.struct(
                (ends[i] - F.length(hit)).alias("start"), ends[i].alias("end"), hit.alias("text"),
                F.right(gaps[i], F.lit(CONTEXT)).alias("before"),
                F.left(gaps[i + 1], F.lit(CONTEXT)).alias("after"),
            ),
        ))

    both = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )
    none = F.from_json(F.lit("[]"), _MATCHES)
    return F.when(text.rlike(hint), let(both, placed)).otherwise(none)


_MATCHES = "array<struct<start:int,end:int,text:string,before:string,after:string>>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass the Luhn check."""
    padded = F.lpad(digits, 20, "0")
    # Each digit doubled, its digits added.
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(20)), F.lit(0),
        lambda sum_, i: sum_ + F.substr(F.when(i % 2 == 0, padded).otherwise(doubled), i, F.lit(1)).cast("int"),
    )
    return F.length(digits).between(13, 19) & F.when(F.length(digits) <= 20, total % 10 == 0).otherwise(False)


def _passes(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        # Most numbers are shorter, and a longer one's sum is not taken.
        return F.length(text).between(13, 37) & luhn(digits_of(text))
    if kind == "phone":
        return F.length(digits_of(text)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Start and end of the base spans of a kind, in order."""
    found = F.filter(matches(text, BASE[kind], HINTS[kind]), lambda m: _passes(kind, m["text"]))
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))


def _known(kind: str, m: Column) -> Column:
    """What is known of a proposal: POSITIVE, NEGATIVE or OPEN."""
    text, before, after = m["text"], m["before"], m["after"]
    if kind == "email":
        positive = text.rlike(rf"{_LOCAL}@[A-Za-z0-9-]++\.[A-Za-z0-9-]")
        negative = ~text.rlike(rf"{_DOT}[\p{{L}}]{{2,}}$")
    elif kind == "ip":
        positive = text.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
        parts = F.split(text, "[^0-9]+")
        negative = (F.size(parts) != 4) | F.exists(parts, lambda p: p.cast("int") > 255)
    elif kind == "card":
        passes = luhn(digits_of(text))
        positive = text.rlike("^[0-9](?:[ -]?[0-9])++$") & passes
        negative = ~passes
    else:
        n = F.length(digits_of(text))
        positive = before.rlike(r"\+[0-9]{0,3}[ .(-]{0,2}$") & n.between(6, 15)
        day = r"(?:0?[1-9]|[12][0-9]|3[01])"
        negative = (
            ~n.between(7, 15)
            | text.rlike(rf"^(?:(?:19|20)[0-9][0-9][./ -]{day}[./ -]{day}|{day}[./ -]{day}[./ -](?:19|20)[0-9][0-9])$")
            | text.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
            | before.rlike(r"[\p{L}_=#$.]$") | after.rlike(r"^[\p{L}_=%]")
        )
    return F.when(positive, POSITIVE).when(negative, NEGATIVE).otherwise(OPEN)


def _side(text: Column, end: str) -> Column:
    """Kind of the nearest code point: none, blank, letter, digit, quote or bracket, sign, other."""
    kinds = [r"\s", r"\p{L}", "[0-9]", r"[\"'()\[\]{}<>]", r"[=:#$%&+]", r"\S"]
    patterns = [f"{k}$" if end == "$" else f"^{k}" for k in kinds]
    out = F.when(F.length(text) == 0, 0)
    for n, pattern in enumerate(patterns, 1):
        out = out.when(text.rlike(pattern), n)
    return out.otherwise(0).cast("int")


def _features(kind: str, m: Column) -> list[Column]:
    # A country code is what makes a phone number known, so it is no part of the context.
    before = F.regexp_replace(m["before"], r"\+[0-9]{0,3}[ .(-]{0,2}$", "")
    small, text = F.lower(before), m["text"]

    def at_most(column: Column, most: int) -> Column:
        return F.least(column, F.lit(most))

    values = (
        F.lit(KINDS.index(kind)),
        at_most(F.length(text), 40),
        at_most(F.length(digits_of(text)), 20),
        at_most(F.length(F.regexp_replace(text, r"[^\p{L}]", "")), 30),
        at_most(F.size(F.split(text, r"[^\p{L}\p{N}]+")), 8),
        at_most(F.length(F.regexp_extract(text, r"([\p{L}\p{N}]*)[^\p{L}\p{N}]*$", 1)), 8),
        text.rlike(r"^[(]?0").cast("int"),
        _side(before, "$"),
        _side(m["after"], "^"),
        small.rlike(CUES[kind]).cast("int"),
        small.rlike(AGAINST).cast("int"),
        text.contains("(").cast("int"),
    )
    return [
        (F.lit(0) if name in HIDDEN[kind] else value.cast("int")).alias(name)
        for name, value in zip(FEATURES, values, strict=True)
    ]


def proposals(text: Column, kind: str) -> Column:
    """A generator's proposals: start, end, what is known, the part for calibration, features."""
    found = matches(text, GENERATORS[kind], PROPOSE_HINTS[kind])
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), _known(kind, m).alias("known"),
        (F.pmod(F.xxhash64(m["text"]), F.lit(FOLDS)) == 0).alias("calibrates"),
        *_features(kind, m),
    ))


def propose(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text), the base spans of each kind, and all proposals."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
        *[base_spans(text, kind).alias(kind) for kind in KINDS],
        F.concat(*[proposals(text, kind) for kind in KINDS]).alias("proposals"),
    )


@dataclass
class Trees:
    """Boosted trees over FEATURES and each kind's threshold, None where none is precise enough.

    A tree is a leaf's value, or a feature, the value up to which it goes left, and two trees.
    """

    start: float
    trees: list
    thresholds: list[float | None]

    def score(self, features: dict[str, Column]) -> Column:
        """The log odds of a proposal, as one expression."""

        def value(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            name, most, left, right = tree
            return F.when(features[name] <= most, value(left)).otherwise(value(right))

        out = F.lit(self.start)
        for tree in self.trees:
            out = out + value(tree)
        return out

    def accepts(self, proposal: Column) -> Column:
        """Whether an open proposal becomes a span."""
        own = {name: proposal[name] for name in FEATURES}
        ok = F.lit(False)
        least = F.when(F.lit(False), F.lit(0.0))
        for k, threshold in enumerate(self.thresholds):
            if threshold is not None:
                least = least.when(own["kind"] == k, threshold)
                ok = F.lit(True)
        # Kinds without a threshold have a NULL one.
        return ok & (proposal["known"] == OPEN) & F.coalesce(self.score(own) >= least, F.lit(False))


def _grow(x: np.ndarray, slope: np.ndarray, bend: np.ndarray, depth: int):
    """One regression tree on first and second derivatives, by exact search of all cuts."""
    leaf = float(-RATE * slope.sum() / (bend.sum() + SMOOTHING))
    if depth == 0 or len(x) < 2:
        return leaf
    best = None
    whole = slope.sum() ** 2 / (bend.sum() + SMOOTHING)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        at = np.searchsorted(values, x[:, f])
        s = np.bincount(at, slope, len(values)).cumsum()[:-1]
        b = np.bincount(at, bend, len(values)).cumsum()[:-1]
        if not len(s):
            continue
        gain = s**2 / (b + SMOOTHING) + (slope.sum() - s) ** 2 / (bend.sum() - b + SMOOTHING) - whole
        i = int(gain.argmax())
        if gain[i] > 1e-6 and (best is None or gain[i] > best[0] + 1e-9):
            best = float(gain[i]), f, int(values[i])
    if best is None:
        return leaf
    _, f, most = best
    left = x[:, f] <= most
    parts = [_grow(x[side], slope[side], bend[side], depth - 1) for side in (left, ~left)]
    return FEATURES[f], most, *parts


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    name, most, left, right = tree
    return np.where(x[:, FEATURES.index(name)] <= most, _value(left, x), _value(right, x))


def grow(x: np.ndarray, positive: np.ndarray, n: np.ndarray, calibrates: np.ndarray) -> Trees:
    """Trees from rows of features with counts ``n``, and thresholds from those kept for it."""
    own = ~calibrates
    yes, no = (n * positive)[own].sum(), (n * ~positive)[own].sum()
    start = math.log((yes + 1) / (no + 1))
    scores, trees = np.full(len(x), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-scores[own]))
        tree = _grow(x[own], n[own] * (p - positive[own]), n[own] * p * (1 - p), DEPTH)
        trees.append(tree)
        scores = scores + _value(tree, x)
    thresholds = []
    for kind in range(len(KINDS)):
        held = calibrates & (x[:, 0] == kind)
        best = None
        order = np.argsort(-scores[held], kind="stable")
        s, count, good = scores[held][order], n[held][order], (n * positive)[held][order]
        all_, right = count.cumsum(), good.cumsum()
        for i in range(len(s)):
            last = i + 1 == len(s) or s[i + 1] < s[i]
            if last and right[i] >= PRECISION * (all_[i] + 1):
                best = float(s[i])
        thresholds.append(best)
    return Trees(start, trees, thresholds)


def learn(found: DataFrame) -> Trees:
    """Trees from all known proposals. Equal feature rows are counted on the cluster; the driver gets
    the different ones, as columns of numbers."""
    rows = (
        found.select(F.explode(F.filter("proposals", lambda p: p["known"] != OPEN)).alias("p"))
        .groupBy(*[F.col(f"p.{name}").alias(name) for name in (*FEATURES, "known", "calibrates")])
        .agg(F.count("*").alias("n"))
        .toArrow()
    )
    if not rows.num_rows:
        return Trees(0.0, [], [None] * len(KINDS))
    rows = rows.sort_by([(name, "ascending") for name in rows.column_names])
    x = np.column_stack([rows[name].to_numpy() for name in FEATURES])
    known, calibrates, n = (rows[name].to_numpy() for name in ("known", "calibrates", "n"))
    return grow(x, known == POSITIVE, n.astype(float), calibrates)


def scan(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` (doc_id and text, other columns are left out) as doc_id, text_key and
    spans: an array of start, end (code points) and kind (its place in KINDS, then in ADDED), by
    kind and start. A null text is empty and has none; a repeated row has its own. Learned from all
    rows of ``docs``; where too few proposals are known, nothing is added to the base spans.
    """
    found = staged(propose(docs), "proposals")
    trees = learn(found)

    def spans(items: Column, kind: Column | int) -> Column:
        return F.transform(items, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            (F.lit(kind) if isinstance(kind, int) else kind(s)).cast("int").alias("kind"),
        ))

    base = [spans(F.col(kind), k) for k, kind in enumerate(KINDS)]
    added = F.filter("proposals", trees.accepts)
    return found.select(
        "doc_id", "text_key",
        F.concat(*base, spans(added, lambda s: s["kind"] + len(KINDS))).alias("spans"),
    )


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, *ADDED)))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
