import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tapemill.llm.bpe_codec import Encoder, Lexicon, Model, compile_lexicon, decode, encode, frequent_words, share_lexicon

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MODEL = Model(PATH)
EMPTY = Lexicon(compile_lexicon({}))
TEXTS = [None, "", " ", "the the  the\n the", "it's <|endoftext|> é中😀", "x" * 2000, "ab" * 900 + " y", " \n \n a", "\x00\x85"]


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ids(raw):
    return list(memoryview(raw).cast("I"))


@given(st.text(alphabet="ab 'the\n é中😀<|endoftext|>\t0²Ⅷ!\0\x1c\x85　", max_size=40))
@settings(max_examples=300, deadline=None)
def test_ids_are_those_of_the_library(text):
    assert ids(Encoder(MODEL, EMPTY).encode(text)) == library(text)


@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 2**32 - 1), max_size=3), max_size=40))
@settings(max_examples=100, deadline=None)
def test_lexicon_gives_back_its_words_and_no_others(words):
    lexicon = Lexicon(compile_lexicon(words))
    asked = [*words, *(word + b"q" for word in words), *(word[:-1] for word in words), b"\xff\xff"]
    assert lexicon.find_all(asked) == [
        b"".join(i.to_bytes(4, "little") for i in words[word]) if word in words else None for word in asked
    ]


def test_suffixes_are_shared():
    lexicon = Lexicon(compile_lexicon({stem + b"ation": [1] for stem in (b"a", b"b", b"c", b"d")}))
    assert len(lexicon.finals) == 1 + len(b"ation") + 1


def test_frame_round_trip(spark, documents):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "no id")]
    docs = documents(rows)
    words = frequent_words(docs)
    assert " the" in words
    encoded = encode(docs, PATH, share_lexicon(spark, words, PATH), text_column="text")
    found = decode(encoded, PATH).collect()
    assert len(found) == len(rows)
    at_once = encode(docs, PATH, share_lexicon(spark, set(), PATH), decoded=True)
    assert sorted(map(str, at_once.collect())) == sorted(map(str, found))
    of = {row["doc_id"]: row for row in found}
    for i, text in rows:
        assert ids(bytes(of[i]["ids"])) == library(text)
        assert of[i]["n_tokens"] == len(library(text))
        assert of[i]["text"] == LIBRARY.decode(library(text), skip_special_tokens=False)


def test_empty_table(spark, documents):
    docs = documents([])
    assert frequent_words(docs) == set()
    assert decode(encode(docs, PATH, share_lexicon(spark, set(), PATH)), PATH).collect() == []


def test_lexicon_is_bounded(documents):
    docs = documents([(1, "x a a a b b b c c"), (2, "y a b c")])
    assert frequent_words(docs, most=2) == {" a", " b"}
    assert frequent_words(docs, most=1) == set()
