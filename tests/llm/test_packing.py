import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from headway.llm import packing
from headway.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\n", "Hello, World's end!", "a" * 300, "naïve  café\tİstanbul ΣΑΣ",
    "<|endoftext|> and <|startoftext|>x", "tab\x1cfile", "日本語 text 123", "é   x",
]


def test_ids_are_those_of_the_library():
    got = WordEncoder(PATH).encode(ODD)
    want = Tokenizer.from_file(PATH).encode_batch([t or "" for t in ODD], add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]


def check_packed(rows, size):
    """Every piece in one place, places gapless from 0, no sequence too long."""
    by = {}
    for row in rows:
        by.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_pieces_and_sequences_against_the_library(spark, documents):
    texts = [*ODD, "word " * 5000, "word " * 5000, "x"]
    pieces = packing.pieces(documents(texts), PATH, 512)
    packed = packing.packed_pieces(pieces, 512).collect()
    library = Tokenizer.from_file(PATH)
    want = {}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for k, start in enumerate(range(0, len(ids), 512)):
            part = np.array(ids[start : start + 512], dtype="<u4").tobytes()
            want[i, k] = (start, len(part) // 4, zlib.crc32(part))
    got = {(r.doc_id, r.piece): (r.start, r.length, zlib.crc32(r.ids)) for r in packed}
    assert got == want and len(packed) == len(want)
    total = sum(r.length for r in packed)
    assert check_packed(packed, 512) == -(-total // 512)


def test_sequences_hold_their_pieces_in_order(documents):
    packed = packing.packed_pieces(packing.pieces(documents(["a b c", "d e", "f"]), PATH, 16), 16)
    one = packing.sequences(packed).collect()
    assert len(one) == 1 and one[0].length == 9 and len(one[0].ids) == 36


def test_repeated_rows_are_packed_each(documents):
    rows = packing.packed_pieces(packing.pieces(documents([(1, "a b")] * 5), PATH, 8), 8).collect()
    assert len(rows) == 5 and check_packed(rows, 8) == 3


def test_empty_table(empty):
    assert packing.packed_pieces(packing.pieces(empty, PATH)).collect() == []


def test_clashing_columns_are_named(spark):
    with pytest.raises(ValueError, match="offset"):
        packing.packed_pieces(spark.createDataFrame([(1, 2)], "length long, offset long"))


@pytest.mark.parametrize("low, high", [(1, 60), (300, 400), (200, 750)])
def test_swaps_never_use_more_bins(low, high):
    lengths = np.random.default_rng(low).integers(low, high, 400)
    bins, n = packing.best_fit(lengths, 1000)
    search = packing.SwapSearch(lengths, bins, n, 1000)
    before = (search.fill**2).sum()
    after = search.run()
    fill = np.bincount(after, weights=lengths, minlength=n)
    assert fill.max() <= 1000 and fill.sum() == lengths.sum()
    assert (fill == search.fill).all() and (fill**2).sum() >= before
    assert -(-lengths.sum() // 1000) <= search.used() <= n


def test_a_swap_empties_a_bin():
    # The 4 fits nowhere; in place of the 1, which then fits beside 5 and 2, it does.
    search = packing.SwapSearch(np.array([4, 5, 2, 6, 1]), np.array([0, 1, 1, 2, 2]), 3, 10)
    after = search.run()
    assert search.used() == 2 and after[0] == after[3] and after[4] == after[1] == after[2]


def test_new_words_are_looked_at_together():
    # Looks for odd characters, one for each new word, took most of a task's time.
    class Counting:
        def __init__(self, pattern):
            self.pattern, self.n = pattern, 0

        def search(self, text):
            self.n += 1
            return self.pattern.search(text)

    encoder = WordEncoder(PATH)
    encoder.odd = looks = Counting(encoder.odd)
    texts = [f"Wort{i} don't-{i} naïve{i}" for i in range(500)]
    library = Tokenizer.from_file(PATH)

    def want(some):
        return [library.encode(t, add_special_tokens=False).ids for t in some]

    assert [np.frombuffer(g, "<u4").tolist() for g in encoder.encode(texts)] == want(texts)
    assert looks.n == 1
    # An odd word among them goes to the library, the others do not.
    mixed = ["neu1 日本 neu2", "<|endoftext|>neu3 neu4"]
    assert [np.frombuffer(g, "<u4").tolist() for g in encoder.encode(mixed)] == want(mixed)
