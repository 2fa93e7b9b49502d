"""Byte-level BPE encoding of whole texts through a lexicon of frequent words, and decoding.

Words are counted over the whole corpus; the most frequent ones, with the ids that merging gives
them, are compiled into a minimal acyclic transducer (``lexicon``). A task memory-maps it, looks
up all distinct words of a slice at once and merges only the words it does not hold.

A word stands for what lies between two blanks, with one blank before it, where white space is even.
Texts with indentation, blank lines or other white space are cut to pretokens instead: one with a blank
before it is a word like any other, and others are words of their own. Only a text that holds a special
token is left to the library, and a single word of many kilobytes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.bpe import LONG_WORD, MergeTable, byte_names, id_bytes
from headway.llm.lexicon import Lexicon, compile_lexicon
from headway.llm.stage import most_frequent, slices

# Words of the lexicon, the most frequent ones. Its size bounds what is broadcast; results do not
# depend on it.
LEXICON_WORDS = 65_536
# Distinct words a task keeps with their ids or counts; beyond, it starts anew.
KNOWN_WORDS = 300_000
_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space but single blanks and line breaks, and what only str.split() takes for it.
_UNEVEN = re.compile(r"[^\S \n]")
_ODD = re.compile("[^\x00-ɏ]|[\x1c-\x1f]")
# Before a pretoken that stands for itself, without a blank; no word of an even text starts so.
_BARE = "\n\n"


def split_words(text: str) -> list[str]:
    """Words at blanks and line breaks. A line's first word keeps the break before it, the text's
    first word counts as such, and any other stands for itself with one blank before it."""
    return ("\n" + text).replace("\n", " \n").split(" ")[1:]


def even(text: str) -> bool:
    """If white space is only single blanks and line breaks between words: then the words of
    ``split_words`` are encoded alike in any context."""
    return not (
        text[0] in " \n"
        or text[-1] in " \n"
        or "  " in text
        or " \n" in text
        or "\n " in text
        or "\n\n" in text
        or _UNEVEN.search(text)
    )


def special_tokens(path: str) -> list[str]:
    from tokenizers import Tokenizer

    return [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]


class Cutter:
    """Cuts texts to what their ids are looked up by. Opens the tokenizer only if it must."""

    def __init__(self, path: str, special: list[str]):
        import regex

        self.path, self.special, self._library = path, special, None
        self.pretokens = regex.compile(_PRETOKEN)

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def parts(self, text: str) -> list[str]:
        """The pretokens of a text. Where kinds of characters may have changed from one version of
        Unicode to the next, the library's own cut is taken."""
        if _ODD.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.pretokens.findall(text)

    def words(self, text: str) -> list[str] | None:
        """What the text's ids are looked up by, in order; None if it holds a special token."""
        if not text:
            return []
        if self.has_special(text):
            return None
        if even(text):
            return split_words(text)
        return [
            part[1:] if part[0] == " " and not part.isspace() else _BARE + part
            for part in self.parts(text)
        ]

    def has_special(self, text: str) -> bool:
        return any(token in text for token in self.special)


class Encoder(Cutter):
    """Ids of texts as the tokenizers library gives them, without special tokens added."""

    def __init__(self, path: str, lexicon: Lexicon | None = None):
        super().__init__(path, special_tokens(path))
        self.table = MergeTable(path)
        self.lexicon = lexicon
        self.line_break = self.by_library("\n")
        self.known: dict[str, bytes] = {}

    def by_library(self, text: str) -> bytes:
        return id_bytes(np.array(self.library.encode(text, add_special_tokens=False).ids))

    def merge(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of words as ``words`` gives them."""
        out: dict[str, bytes] = {}
        plain, cut, words = [], {}, list(words)
        # Most often no word is of an odd kind, which one look at all of them tells.
        whole = " ".join(words)
        if not _ODD.search(whole) and _BARE not in whole and max(map(len, words), default=0) <= LONG_WORD:
            plain, words = words, []
        for word in words:
            odd = _ODD.search(word)
            if not odd and word[:2] != _BARE and len(word) <= LONG_WORD:
                plain.append(word)
                continue
            bare, first = word[:2] == _BARE, word[0] == "\n"
            text = word[2:] if bare else word[1:] if first else " " + word
            if len(word) > LONG_WORD:
                ids = self.by_library(text)
                out[word] = self.line_break + ids if first and not bare else ids
            else:
                cut[word] = [text] if bare else ["\n"] * first + self.parts(text)
        if cut:
            ids = self._pretoken_ids([part for parts in cut.values() for part in parts])
            out |= {word: b"".join(map(ids.__getitem__, parts)) for word, parts in cut.items()}
        if not plain:
            return out
        text = "".join([word if word[0] == "\n" else "\n " + word for word in plain])
        parts = self.pretokens.findall(text)[1:]
        parts.append("\n")
        ids = self._pretoken_ids(parts)
        ids["\n"] = None
        found, words = [], iter(plain)
        for part in map(ids.__getitem__, parts):
            if part is None:
                word = next(words)
                if word[0] == "\n":
                    found.insert(0, self.line_break)
                out[word] = b"".join(found)
                found = []
            else:
                found.append(part)
        return out

    def _pretoken_ids(self, parts: list[str]) -> dict[str, bytes]:
        ids = dict.fromkeys(parts)
        flat, ends = self.table.encode([part.encode() for part in ids])
        flat = id_bytes(flat)
        start = 0
        for part, end in zip(ids, (ends * 4).tolist(), strict=True):
            ids[part] = flat[start:end]
            start = end
        return ids

    def learn(self, new: set[str]) -> None:
        words = list(new)
        if self.lexicon is not None and words:
            place = self.lexicon.lookup([word.encode() for word in words])
            held = np.flatnonzero(place >= 0)
            for i, at in zip(held.tolist(), place[held].tolist(), strict=True):
                self.known[words[i]] = self.lexicon.ids_of(at)
            words = [words[i] for i in np.flatnonzero(place < 0)]
        self.known.update(self.merge(words))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.words(text or "") for text in texts]
        every = set().union(*(words for words in split if words))
        new = every.difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, new = {}, every
        self.learn(new)
        known, out = self.known.__getitem__, []
        for text, words in zip(texts, split, strict=True):
            if words is None:
                out.append(self.by_library(text))
                continue
            # The first word of an even text counts as a line's first.
            skip = len(self.line_break) if words and words[0][0] == "\n" and words[0][:2] != _BARE else 0
            out.append(b"".join(map(known, words))[skip:])
        return out


class Decoder:
    """Texts of ids, special tokens included."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        byte_of = {name: byte for byte, name in enumerate(byte_names())}
        self.bytes_of = [b""] * library.get_vocab_size()
        for token, number in library.get_vocab().items():
            if all(c in byte_of for c in token):
                self.bytes_of[number] = bytes(byte_of[c] for c in token)
            else:
                self.bytes_of[number] = token.encode()

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """How often each word occurs in all texts: word, n."""

    special = special_tokens(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        cutter = Cutter(tokenizer, special)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(list(counts), pa.string()),
                    "n": pa.array(list(counts.values()), pa.int64()),
                }
            )

        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(cutter.words(text or "") or ())
            if len(counts) > KNOWN_WORDS:
                yield rows()
                counts.clear()
        yield rows()

    counted = docs.select("text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> Lexicon:
    """The lexicon of the ``size`` most frequent words of ``text``, ties by word; empty without
    texts."""
    frequent = word_counts(docs, tokenizer).where("length(word) BETWEEN 1 AND 64")
    words = [row["word"] for row in most_frequent(frequent, ["word"], size).collect()]
    ids = Encoder(tokenizer).merge(words)
    return compile_lexicon(
        {word.encode(): np.frombuffer(ids[word], dtype="<u4") for word in words}
    )


def round_trip(docs: DataFrame, tokenizer: str, lexicon: Lexicon) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and decoded, the text of those ids.
    A null text counts as empty; repeated rows stay."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon.to_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(tokenizer, Lexicon.mapped(held.value)), Decoder(tokenizer)
        for batch in slices(batches, "text"):
            ids = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                    "decoded": pa.array([decoder.decode(i) for i in ids], pa.string()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, ids binary, decoded string"
    )
