"""Whole texts to ids of a word-end BPE vocabulary, word by word."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, islice

import numpy as np

from headway.llm.bpe import LONG_WORD, MergeTable

# Distinct words whose ids a task keeps; beyond, it keeps those of the last texts. Bounds memory, not
# results.
KNOWN_WORDS = 400_000
# Words whose ids are put together at a time.
JOINED_WORDS = 1 << 18
# Characters up to here are lower-cased and classed alike everywhere and never composed; a word
# with any beyond goes to the tokenizers library.
_SIMPLE = "ɏ"
_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|\n|[^\s\p{L}\p{N}]+"
# Characters that str.split() takes for white space and the vocabulary's normalizer doesn't.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"


class _Numbers(dict):
    """Numbers words from 0, in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class WordEncoder:
    """Ids of texts as the tokenizers library gives them for a vocabulary that lower-cases, drops
    white space and merges within words.

    Each distinct white-space-delimited word is encoded once, all new ones of a slice together.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.table = MergeTable(path)
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pretokens = regex.compile(_PRETOKEN)
        # What a word must not hold to be merged here: other characters, and special tokens.
        odd = [f"[^\x00-{_SIMPLE}]", *map(regex.escape, self.special)]
        self.odd = regex.compile("|".join(odd))
        # Of the word of each number: where its ids lie, and how many.
        self.known = _Numbers()
        self.ids = np.empty(0, dtype="<u4")
        self.starts = self.sizes = np.empty(0, dtype=np.int64)

    def by_library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words in a row, and how many each has."""
        if not words:
            return self.ids[:0], self.sizes[:0]
        parts = self.pretokens.findall("\n".join(words).lower())
        parts.append("\n")
        distinct = dict.fromkeys(parts)
        distinct.pop("\n")
        ids, ends = self.table.encode([part.encode() for part in distinct])
        # Every word's parts end with a line break, which adds nothing.
        number = dict(zip(distinct, range(len(distinct)), strict=True)) | {"\n": len(distinct)}
        part = np.fromiter(map(number.__getitem__, parts), dtype=np.int64, count=len(parts))
        starts, stops = np.r_[0, ends], np.r_[ends, ends[-1:]]
        after = np.cumsum((stops - starts)[part])[part == len(distinct)]
        return _gathered(ids.astype("<u4"), starts[part], (stops - starts)[part]), np.diff(after, prepend=0)

    def learn(self, words: list[str]) -> None:
        """Adds ids of the words that come next by number."""
        odd = np.zeros(len(words), dtype=bool)
        # Words are looked at one by one only where some of them are odd.
        if max(map(len, words), default=0) > LONG_WORD or self.odd.search("\n".join(words)):
            odd[:] = [len(word) > LONG_WORD or bool(self.odd.search(word)) for word in words]
        plain = [word for word, n in zip(words, odd.tolist(), strict=True) if not n]
        ids, own = self.merged(plain)
        by_library = [self.by_library(words[n]) for n in np.flatnonzero(odd).tolist()]
        sizes, starts = np.empty((2, len(words)), dtype=np.int64)
        sizes[~odd], sizes[odd] = own, list(map(len, by_library))
        order = np.argsort(odd, kind="stable")
        starts[order] = np.cumsum(sizes[order]) - sizes[order] + len(self.ids)
        self.ids = np.concatenate([self.ids, ids, *by_library])
        self.starts, self.sizes = np.r_[self.starts, starts], np.r_[self.sizes, sizes]

    def keep(self, numbers: np.ndarray) -> None:
        """Forgets all words but those of the numbers."""
        words, numbers = list(self.known), np.unique(numbers)
        self.known = _Numbers(zip(map(words.__getitem__, numbers.tolist()), range(len(numbers))))
        self.ids = _gathered(self.ids, self.starts[numbers], self.sizes[numbers])
        self.sizes = self.sizes[numbers]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def lowered(self, text: str) -> str:
        """The text in lower case where that changes no ids, so that its words are fewer."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        low = text.lower()
        return text if any(token in low for token in self.special) else low

    def encode(self, texts: list[str | None]) -> list[bytes]:
        odd = [bool(text) and any(c in text for c in _ODD_SPACE) for text in texts]
        counts = [0]

        def split() -> Iterator[list[str]]:
            for text, by_library in zip(texts, odd, strict=True):
                words = [] if by_library else self.lowered(text or "").split()
                counts.append(len(words))
                yield words

        # Each text's words are looked up and gone before the next are made.
        words = chain.from_iterable(split())
        numbers = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64)
        if new := list(islice(self.known, len(self.sizes), None)):
            self.learn(new)
        cuts = range(0, len(numbers), JOINED_WORDS)
        some = (numbers[at : at + JOINED_WORDS] for at in cuts)
        ids = b"".join([_gathered(self.ids, self.starts[n], self.sizes[n]).tobytes() for n in some])
        # Of texts, where the ids end that come before them.
        ends = (np.r_[0, np.cumsum(self.sizes[numbers])][np.cumsum(counts)] * 4).tolist()
        if len(self.known) > KNOWN_WORDS:
            self.keep(numbers)
        return [
            self.by_library(text).tobytes() if by_library else ids[a:b]
            for text, by_library, a, b in zip(texts, odd, ends, ends[1:], strict=False)
        ]


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """So many ids from each start on, in a row."""
    before = np.cumsum(sizes) - sizes
    return ids[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
