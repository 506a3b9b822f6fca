import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from __spark_entry__ import queries

from tapemill.llm import token_alignment
from tapemill.llm.token_alignment import PerfectHash, pair_figures, tokenizers

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def other_a():
    """The same vocabulary in another library."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute_force(texts, other_a):
    """Rows of the contract, from plain loops over bytes."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        name = pieces.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()

    cut = []
    for text in texts:
        a, b = (other_a.encode_ordinary(" " + text), pieces.encode(text)) if text else ([], [])
        sides = []
        for ids, bytes_of in ((a, other_a.decode_single_token_bytes), (b, piece)):
            at, ends, whole = 0, [], b""
            for i in ids:
                whole += bytes_of(i)
                at = len(whole)
                ends.append(at)
            sides.append((ids, ends, whole))
        if not text or any(side[2] != (" " + text).encode() for side in sides):
            sides = [([], [], b"")] * 2
        groups, links, begin = [], [], [0, 0]
        ending = [{end: k for k, end in enumerate(side[1])} for side in sides]
        for end in sorted(set(sides[0][1]) & set(sides[1][1])):
            upto = [by_end[end] + 1 for by_end in ending]
            groups.append("|".join(",".join(map(str, s[0][f:t])) for s, f, t in zip(sides, begin, upto, strict=True)))
            links.append(tuple(side[0][k - 1] for side, k in zip(sides, upto, strict=True)))
            begin = upto
        cut.append((len(sides[0][0]), len(sides[1][0]), groups, links))
    count = Counter(link for *_, links in cut for link in links)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(highest.get(b, 0), n)
    return [
        (
            n_a, n_b, len(groups), len(links), sum(count[x] == highest[x[1]] for x in links),
            sum(count[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for n_a, n_b, groups, links in cut
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def result(frame):
    rows = pair_figures(frame, A, B).collect()
    return [(row["doc_id"], *(row[c] for c in COLUMNS)) for row in sorted(rows, key=lambda r: (r["doc_id"] or 0))]


def hostile(rng):
    parts = ["the ", "  ", "\n\n", "é", "ß", "日本", "🙂", "<|endoftext|>", "</s>", "<0x41>", "\t", "1234", "don't", "ﬁ",
             " ", "▁", "naïve", "Zażółć ", "\x00", "á"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))


@pytest.mark.parametrize(("pairs", "piece", "kept"), [(1 << 21, 1 << 16, 1 << 20), (150, 16, 50)])
def test_against_brute_force(spark, documents, monkeypatch, other_a, pairs, piece, kept):
    monkeypatch.setattr(token_alignment, "SHARD_PAIRS", pairs)
    monkeypatch.setattr(token_alignment, "PIECE", piece)
    monkeypatch.setattr(token_alignment, "KEPT_PAIRS", kept)
    monkeypatch.setattr(token_alignment, "FAN_IN", 2)
    rng = random.Random(3)
    texts = [hostile(rng) for _ in range(300)] + ["Repeated words of a copy"] * 100 + [None, "", " ", "x"]
    found = result(documents(list(enumerate(texts)), 6))
    assert [row[1:] for row in found] == brute_force(texts, other_a)


def test_query_over_its_table(spark, other_a):
    sf_dir = "/root/testdata/sf0.001"
    made = queries()["op13_token_alignment"](spark, sf_dir).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas().sort_values("doc_id")
    assert made.doc_id.tolist() == docs.doc_id.tolist()
    assert list(made[COLUMNS].itertuples(index=False, name=None)) == brute_force(docs.text.tolist(), other_a)


def test_edge_rows(spark, documents, other_a):
    texts = ["w" * 40_000 + " end", "same id", "no id"]
    found = pair_figures(documents([(1, texts[0]), (1, texts[1]), (None, texts[2])]), A, B).collect()
    assert sorted(tuple(row[c] for c in COLUMNS) for row in found) == sorted(brute_force(texts, other_a))
    assert pair_figures(documents([]), A, B).collect() == []
    assert [row["n_a"] for row in pair_figures(documents([(1, None), (2, "▁")]), A, B).collect()] == [0, 0]


def test_every_entry_is_a_token_by_itself():
    """What makes the two ways of merging the same."""
    own = tokenizers(A, B)
    parts = tokenizers_library_merges(own, range(len(own.bytes_a)))
    assert parts == [[i] for i in range(len(parts))]


def tokenizers_library_merges(own, ids):
    names = {i: name for name, i in own.a.get_vocab().items()}
    return [[token.id for token in own.a.model.tokenize(names[i])] if i not in (50256,) else [i] for i in ids]


def test_latin_texts_are_cut_as_by_the_library():
    own = tokenizers(A, B)
    rng = random.Random(9)
    letters = [chr(c) for c in (*range(0, 0x250), *[32] * 200, *map(ord, "etaoinsr" * 30))]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice(" ea\nst1'") for _ in range(40)) for _ in range(2000)]
    assert all(token_alignment._LATIN(text) for text in texts)
    expected = [e.ids for e in own.a.encode_batch(texts, add_special_tokens=False)]
    assert [own.latin.encode_ordinary(text) for text in texts] == expected


def test_every_id_has_bytes():
    own = tokenizers(A, B)
    assert own.length_b.min() > 0
    assert own.length_a.min() > 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n, dtype=np.uint64))
    places = PerfectHash(keys)
    assert sorted(places.index(keys)) == list(range(len(keys)))
    foreign = np.arange(1000, dtype=np.uint64) + np.uint64(1 << 63)
    assert (places.index(foreign) == -1).all()
