"""Secret scans: fixed patterns, and strings in sensitive contexts that do not compress.

The patterns give the base spans. The method adds strings that follow a sensitive word within a
few code points and that zstandard, primed with the identifiers that the corpus uses around such
words, cannot make shorter: the novelty of a candidate is the number of bits by which it lengthens
its compressed surroundings, as a share of what a random string of its length and alphabet holds.
A word, path or identifier costs a few bytes, a random key all that it holds. Candidates and base
spans are blank in all surroundings, and no identifier of a candidate is primed, so that copies of
a string, near or in other texts, do not make it known.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.stage import discard, most_frequent, slices, staged

KINDS = ("assign", "access", "hex")
NOVEL = "novel"
ASSIGN = re.compile(
    r"(?a:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
SENSITIVE = re.compile(
    r"(?a:(?i:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|private[_ -]?key|"
    r"access[_-]?key|credential|bearer|authorization))"
)
# Strings that may be secrets: runs of these, of such a length at least.
LEAST_LENGTH = 16
_START = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_LENGTH}}}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
# Code points after a sensitive word in which a candidate may start, and of the surroundings that
# are compressed with it.
REACH, AROUND = 64, 160
# A candidate is reported if it adds this share of the bits that a random string of its alphabet
# holds, or more.
NOVELTY = 1.1
# Fewest bits of a character: those of hex digits, so that rows of dashes are not novel.
LEAST_BITS = 4.0
# Identifiers of the dictionary, the most frequent ones; bounds what is broadcast.
DICTIONARY_WORDS = 4096
LEVEL = 9
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")
# An identifier made of words alone also stands for these; random strings rarely are.
_PART = re.compile(r"[A-Z]?[a-z]{2,14}|[A-Z]{3,15}")
_PARTS = re.compile(r"_*(?:(?:[A-Z]?[a-z]{2,14}(?![a-z])|[A-Z]{3,15}(?![A-Za-z]))_*)+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind (its place in KINDS) and end of the fixed patterns' matches, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Start and end of strings soon after a sensitive word that no base span overlaps.

    Words within a string, too, have one that starts after them; of those with one end the first
    and the last count, so that a text is read once however many words it has."""
    first: dict[int, int] = {}
    last: dict[int, int] = {}
    # The strings met so far, each read to its end once.
    begins: list[int] = []
    ends: list[int] = []
    for word in SENSITIVE.finditer(text):
        at, stop = word.end(), word.end() + REACH
        # A start before ``stop``, looked for no farther than it takes.
        while match := _START.search(text, at, stop + LEAST_LENGTH - 1):
            start = match.start()
            if not ends or start >= ends[-1]:
                begins.append(start)
                ends.append(_RUN.match(text, start).end())
            at = ends[bisect_right(begins, start) - 1]
            first.setdefault(at, start)
            last[at] = start
    out = sorted({(a, b) for starts in (first, last) for b, a in starts.items()})
    # Spans come by start; the farthest end of those before tells whether one reaches in.
    starts = [s for s, _, _ in spans]
    farthest = list(accumulate((e for _, _, e in spans), max))
    return [
        (a, b) for a, b in out if not (n := bisect_left(starts, b)) or farthest[n - 1] <= a
    ]


def blanked(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text with blanks in place of the ranges, as long as before."""
    out, at = [], 0
    for start, end in sorted(ranges):
        start = max(start, at)
        if end > start:
            out += [text[at:start], " " * (end - start)]
            at = end
    return "".join([*out, text[at:]])


def _surroundings(clean: str, string: str, start: int, end: int) -> tuple[str, str]:
    """What stands before and after, without copies of the string."""
    before = clean[max(0, start - AROUND - len(string)) : start]
    after = clean[end : end + AROUND + len(string)]
    blank = " " * len(string)
    return before.replace(string, blank)[-AROUND:], after.replace(string, blank)[:AROUND]


_SPAN = "struct<start:int,kind:int,end:int>"
_CANDIDATE = "struct<start:int,end:int,before:string,string:string,after:string>"


def _asked(text: str, own: list[tuple[int, int, int]]) -> Iterator[dict]:
    """Candidates of a text with their surroundings."""
    asking = candidates(text, own)
    clean = blanked(text, [(s, e) for s, _, e in own] + asking) if asking else ""
    for a, b in asking:
        before, after = _surroundings(clean, text[a:b], a, b)
        yield {"start": a, "end": b, "before": before, "string": text[a:b], "after": after}


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    asked = pa.struct(
        [("start", pa.int32()), ("end", pa.int32())]
        + [(n, pa.string()) for n in ("before", "string", "after")]
    )
    for batch in slices(batches, "text"):
        spans, found = [], []
        for text in batch.column("text").to_pylist():
            own = base_spans(text or "")
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
            found.append(list(_asked(text or "", own)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("text_key"),
                pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(asked)),
            ],
            ["doc_id", "text_key", "spans", "candidates"],
        )


def known_words(text: str) -> set[str]:
    """Identifiers, and the words of those that are made of words alone."""
    own = set(_IDENTIFIER.findall(text))
    return own.union(*[_PART.findall(x) for x in own if _PARTS.fullmatch(x)])


def _identifiers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words around candidates, and with a count of 0 the identifiers of candidates themselves
    (short plain words are nobody's)."""
    counts: Counter[str] = Counter()
    asked: set[str] = set()

    def rows() -> pa.RecordBatch:
        words = [*counts, *asked]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.string()),
                pa.array([*counts.values(), *[0] * len(asked)], pa.int64()),
                pa.array([False] * len(counts) + [True] * len(asked), pa.bool_()),
            ],
            ["word", "n", "asked"],
        )

    for batch in batches:
        for own in batch.column("candidates").to_pylist():
            for one in own:
                counts.update(known_words(f"{one['before']} {one['after']}"))
                asked.update(
                    x for x in _IDENTIFIER.findall(one["string"]) if not _PART.fullmatch(x)
                )
        if len(counts) + len(asked) > 100_000:
            yield rows()
            counts.clear()
            asked.clear()
    yield rows()


_LETTERS = re.compile(r"[a-z]"), re.compile(r"[A-Z]")
_DIGIT = re.compile(r"[0-9]")
_ONE_CASE_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def alphabet_bits(string: str) -> float:
    """Bits of a character of a random string with the same kinds of characters: hex digits of one
    case, else letters of either case and digits; each symbol is one more."""
    if _ONE_CASE_HEX.fullmatch(string):
        return LEAST_BITS
    size = sum(26 for kind in _LETTERS if kind.search(string)) + 10 * bool(_DIGIT.search(string))
    size += len(set(string) & set("+/_=-"))
    return max(LEAST_BITS, math.log2(max(size, 1)))


class Novelty:
    """Marginal compressed bits, with a dictionary of identifiers."""

    def __init__(self, dictionary: bytes):
        import zstandard

        primed = (
            zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            if len(dictionary) >= 8 else None
        )
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, **options)
        self.compressor = zstandard.ZstdCompressor(dict_data=primed, compression_params=parameters)

    def _length(self, text: str) -> int:
        return len(self.compressor.compress(text.encode()))

    def share(self, before: str, string: str, after: str, known: str = "") -> float:
        """Bits added, as a share of those that a random string alike holds; ``known`` are words of the
        string that the corpus uses and the dictionary has no room for."""
        lead = f"{known} " if known else ""
        # With both sides and with one: a block that just gains or loses its Huffman codes changes
        # one of the three by as much as a short string has, not their median.
        added = sorted(
            self._length(lead + b + string + a) - self._length(lead + b + a)
            for b, a in ((before, after), (before, ""), ("", after))
        )[1]
        return 8 * added / (alphabet_bits(string) * len(string))


def _found(docs: DataFrame) -> DataFrame:
    """Base spans and candidates of each row."""
    return staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
        ).mapInArrow(
            _finder,
            f"doc_id long, text_key long, spans array<{_SPAN}>, candidates array<{_CANDIDATE}>",
        ),
        "secrets",
    )


def _dictionary(found: DataFrame) -> tuple[bytes, DataFrame | None]:
    """Identifiers around candidates: the most frequent ones as text, and, if there are more, those of
    each text's candidates among all others, as text_key and ``known``, a map from the string."""
    asking = found.where(F.size("candidates") > 0)
    words = (
        asking.select("candidates")
        .mapInArrow(_identifiers, "word string, n long, asked boolean").groupBy("word")
        .agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
        .where("n > 1 AND NOT asked").select("word", "n")
    )
    words = staged(words, "words")
    most = [r["word"] for r in most_frequent(words, ["word"], DICTIONARY_WORDS).collect()]
    # What comes last in a dictionary is found cheapest, so the most frequent words do.
    dictionary = " ".join(reversed(most)).encode()
    if len(most) < DICTIONARY_WORDS:
        return dictionary, None
    others = words.join(words.sparkSession.createDataFrame([(w,) for w in most], "word string"), "word", "left_anti")
    own = asking.select("text_key", "candidates").mapInArrow(
        _words_of_candidates, "text_key long, string string, word string"
    ).distinct()
    by_string = own.join(others.select("word"), "word").groupBy("text_key", "string").agg(
        F.concat_ws(" ", F.sort_array(F.collect_set("word"))).alias("words")
    )
    known = F.map_from_entries(F.collect_list(F.struct("string", "words"))).alias("known")
    return dictionary, staged(by_string.groupBy("text_key").agg(known), "known")


def _words_of_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            {"text_key": key, "string": one["string"], "word": word}
            for key, own in zip(*[batch.column(n).to_pylist() for n in ("text_key", "candidates")], strict=True)
            for one in own for word in sorted(known_words(one["string"]))
        ]
        kinds = pa.schema([("text_key", pa.int64()), ("string", pa.string()), ("word", pa.string())])
        yield pa.RecordBatch.from_pylist(rows, schema=kinds)


def _with_known(rows: DataFrame, others: DataFrame | None) -> DataFrame:
    """Adds ``known`` of each row's text_key."""
    if others is None:
        return rows.withColumn("known", F.lit(None).cast("map<string,string>"))
    return rows.join(others, "text_key", "left")


def _novel(novelty: Novelty, one: dict, known: list | None) -> bool:
    words = dict(known or ()).get(one["string"], "")
    return novelty.share(one["before"], one["string"], one["after"], words) >= NOVELTY


def scan(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` (doc_id and text, other columns are left out) as doc_id, text_key (a
    hash of the text) and spans, an array of start, kind (0 to 3 for assign, access, hex, novel)
    and end in code points, sorted. A null text is empty and has none; a repeated row has its own.
    """
    found = _found(docs)
    dictionary, others = _dictionary(found)
    dictionary = docs.sparkSession.sparkContext.broadcast(dictionary)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary.value)
        for batch in batches:
            spans = []
            for own, asked, known in zip(
                *[batch.column(n).to_pylist() for n in ("spans", "candidates", "known")], strict=True
            ):
                own += [
                    {"start": one["start"], "kind": len(KINDS), "end": one["end"]}
                    for one in asked if _novel(novelty, one, known)
                ]
                spans.append(sorted(own, key=lambda s: (s["start"], s["kind"])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"),
                    pa.array(spans, batch.schema.field("spans").type),
                ],
                ["doc_id", "text_key", "spans"],
            )

    return _with_known(found, others).mapInArrow(judge, f"doc_id long, text_key long, spans array<{_SPAN}>")


def written(spans):
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, NOVEL)))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _marked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of overlapping spans in ``text`` replaced by the mark. Other columns
    stay, a null text stays null. The dictionary is made first; texts are then judged and changed
    where they are, so none is shuffled, unless there are more words than it has room for."""
    found = _found(docs)
    dictionary, others = _dictionary(found)
    dictionary = docs.sparkSession.sparkContext.broadcast(dictionary)
    discard(found)
    place = docs.columns.index("text")
    columns = [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary.value)
        for batch in slices(batches, f"c{place}"):
            texts = batch.column(place).to_pylist()
            words = batch.column("known").to_pylist()
            for number, (text, known) in enumerate(zip(texts, words, strict=True)):
                own = base_spans(text or "")
                spans = [(s, e) for s, _, e in own]
                spans += [(one["start"], one["end"]) for one in _asked(text or "", own) if _novel(novelty, one, known)]
                if spans:
                    texts[number] = _marked(text, spans, mark)
            arrays = list(batch.columns)[: len(columns)]
            arrays[place] = pa.array(texts, arrays[place].type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    # Positions stand for the columns' names, of which some may be alike but for their case.
    named = docs.toDF(*columns)
    keyed = _with_known(named.withColumn("text_key", F.xxhash64(columns[place])), others)
    return keyed.select(*columns, "known").mapInArrow(run, named.schema).toDF(*docs.columns)
