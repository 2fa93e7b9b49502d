import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import encoding
from headway.llm.bpe import MergeTable
from headway.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
WORDS = ["the", "there", "\nThe", "other's", "1234,", "café", "a"]
IDS = encoding.Encoder(PATH).merge(WORDS)
LEXICON = compile_lexicon({w.encode(): np.frombuffer(IDS[w], "<u4") for w in WORDS})
ENCODER, DECODER = encoding.Encoder(PATH, LEXICON), encoding.Decoder(PATH)

PARTS = st.sampled_from(
    ["the", "there", " ", "\n", "  ", "'s", "other's", "1234,", "é", "<|endoftext|>", "\t", "\x1c",
     "\xa0", "字", "Σ", "!?", "é", "x" * 80]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join) | st.text(max_size=30))
def test_ids_and_texts_are_those_of_the_library(text):
    ids = ENCODER.encode([text])[0]
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert DECODER.decode(ids) == LIBRARY.decode(want, skip_special_tokens=False)


def test_lexicon_holds_its_words_only():
    mapped = Lexicon.mapped(LEXICON.to_bytes())
    order = sorted(w.encode() for w in WORDS)
    assert mapped.lookup(order).tolist() == list(range(len(WORDS)))
    assert mapped.lookup([b"th", b"thex", b"zebra", b"\xff"]).tolist() == [-1] * 4
    for place, word in enumerate(order):
        assert mapped.ids_of(place) == IDS[word.decode()]


def test_lexicon_is_minimal():
    ids = np.array([1])
    lexicon = compile_lexicon({w: ids for w in (b"tap", b"taps", b"top", b"tops")})
    assert len(lexicon.final) == 5 and len(lexicon.arcs) == 5


def test_merging_equal_pairs_goes_from_left():
    words = ["aaaa", "aaaaaaa", "ababab", "e", "zzzzz"]
    ids, ends = MergeTable(PATH).encode([w.encode() for w in words])
    for word, a, b in zip(words, [0, *ends[:-1]], ends, strict=True):
        assert ids[a:b].tolist() == LIBRARY.encode(word, add_special_tokens=False).ids


def test_round_trip_of_a_table(documents):
    texts = [None, "", "the the there\nThe end", "the the there\nThe end", " odd  white\tspace ", "x" * 90_000]
    docs = documents(texts)
    lexicon = encoding.build_lexicon(docs, PATH, 3)
    assert len(lexicon.ends) == 3
    rows = {r.doc_id: r for r in encoding.round_trip(docs, PATH, lexicon).collect()}
    for i, text in enumerate(texts):
        want = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == want and rows[i].decoded == (text or "")


def test_empty_table(empty):
    lexicon = encoding.build_lexicon(empty, PATH)
    assert len(lexicon.ends) == 0
    assert encoding.round_trip(empty, PATH, lexicon).collect() == []


def test_uneven_and_foreign_texts_go_through_the_lexicon(documents):
    texts = [
        "\tif x:\n\t\treturn the  value\n\n\n", "  indented the\n    the\r\nend ", "字 the 日本 語 の\u3000文。the",
        "Ωmega Σigma\n\nthe", "\x1cthe\x85end", "a 𝔘𝔫𝔦 😀😀 the\n", "'s the 's\n 's  's",
    ]
    lexicon = encoding.build_lexicon(documents(texts), PATH, 500)
    encoder = encoding.Encoder(PATH, lexicon)
    merged = []
    merge = encoder.merge
    encoder.merge = lambda words: merged.extend(words) or merge(words)
    encoder.by_library = None
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    # The lexicon held all of them, so nothing was merged and nothing left to the library.
    assert merged == []


WHITE = st.sampled_from([" ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "\u3000", "\x1f", "\x85", ""])
WORD = st.sampled_from(["the", "'s", "x1", "字字", "Σ", "é", "e\u0301", "!?", "1²½", "😀", "\u200b", "ǅ", "\ud7ff"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(WORD, WHITE), max_size=12).map(lambda p: "".join(a + b for a, b in p)))
def test_uneven_texts_have_the_ids_of_the_library(text):
    ids = ENCODER.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
