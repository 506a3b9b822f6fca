import random

import numpy as np
import pytest

from tapemill.llm import ngram_join
from tapemill.llm.ngram_join import (
    _shingles,
    at_most_shared,
    bands,
    needed,
    shingle_set,
    signatures,
    similar,
    similar_documents,
    sketch,
)


def brute_force(rows):
    texts = [(i, text) for i, text in rows if i is not None]
    of = {i: i for i, _ in texts}
    sets = [(i, _shingles(text or "")) for i, text in texts]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if x & y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    for _ in of:
        for a, b in links:
            of[a] = of[b] = min(of[a], of[b])
    sizes = {}
    for i, own in sets:
        sizes[i] = max(sizes.get(i, 0), len(own))
    return {i: (sizes[i], of[i]) for i in of}


def result(frame):
    return {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in similar_documents(frame).collect()}


def corpus(seed, groups, copies, sizes, boilerplate=0):
    """Groups of edited copies; some texts also hold a common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    common = [word() for _ in range(boilerplate)]
    rows = []
    for _ in range(groups):
        text = [word() for _ in range(rng.choice(sizes))]
        for _ in range(copies):
            made = [w if rng.random() > rng.choice((0, 0.01, 0.03, 0.06)) else word() for w in text]
            rows.append(" ".join([*made, *common] if rng.random() < 0.7 else made))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(
    ("seed", "sizes", "boilerplate"),
    [(1, (1, 3, 4, 5, 6, 7, 9, 12, 20), 0), (2, (30, 36, 40, 60, 90, 200), 0), (3, (8, 15, 40, 70), 40), (4, (2, 4), 60)],
)
def test_against_brute_force(documents, seed, sizes, boilerplate):
    rows = corpus(seed, 40, 6, sizes, boilerplate)
    assert result(documents(rows)) == brute_force(rows)


def test_crowded_buckets_lose_no_pair(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", 2)
    rows = corpus(6, 40, 4, (20, 40, 50, 80), 60)
    assert result(documents(rows)) == brute_force(rows)


@pytest.mark.parametrize("known", [0, 3, 64])
def test_near_copies_that_hardly_miss(documents, monkeypatch, known):
    """A third of the rows around one text, most pairs of them just not similar enough: all in the same crowded buckets."""
    monkeypatch.setattr(ngram_join, "KNOWN", known)
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    rng = random.Random(known)
    base = [f"b{i}" for i in range(150)]
    rows = [" ".join(w if rng.random() > 0.017 else f"e{rng.randint(0, 10**6)}" for w in base) for _ in range(250)]
    rows += [" ".join(f"o{rng.randint(0, 400)}" for _ in range(80)) for _ in range(250)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    expected = brute_force(rows)
    assert len({of for _, of in expected.values()}) > 260
    assert result(documents(rows)) == expected


def test_groups_of_sorted_rows():
    import pyarrow as pa

    keys = [1, 1, 1, 2, 2, 3, 5, 5, 5, 5]
    table = pa.table({"k": keys, "x": [0] * 10, "y": [0] * 10, "v": list(range(10))})
    for size in (1, 2, 3, 10):
        made = [g.column("v").to_pylist() for g in ngram_join._groups(iter(table.to_batches(size)), 3)]
        assert made == [[0, 1, 2], [3, 4], [5], [6, 7, 8, 9]]
    assert list(ngram_join._groups(iter([]), 3)) == []


def test_all_texts_of_an_id_link(documents):
    first, second, third, fourth = ([f"{c}{i}" for i in range(24)] for c in "xyzw")
    rows = [(1, first), (5, first), (5, second), (9, [*second[:-1], "other"])]
    # These share every shingle of the second text between them, and are smaller than its id.
    rows += [(2, [*second[:14], *third[14:]]), (3, [*fourth[:10], *second[10:]])]
    rows = [(i, " ".join(words)) for i, words in rows]
    assert result(documents(rows)) == brute_force(rows)
    assert {i for i, (_, of) in brute_force(rows).items() if of == 1} == {1, 5, 9}


def test_edge_rows(documents):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "One two"), (5, "one TWO"), (6, "two one"), (None, "one two")]
    rows += [(7, "É a b c d"), (8, "é a b c d"), (9, long), (10, long + " y"), (11, "a b c d e"), (11, "one two")]
    assert result(documents(rows)) == brute_force(rows)
    assert similar_documents(documents([])).collect() == []


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in [*range(1, 80), 120, 127, 128, 170, 255, 256, 300, 1000, 5000, 22_000]:
        for _ in range(8):
            tokens = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            other = rng.integers(0, 2**63, size).astype(np.uint64)
            dropped = rng.integers(0, size // 4 + 1)
            added = rng.integers(0, max(0, size // 4 - dropped) + 1)
            near = np.unique(np.concatenate([tokens[dropped:], other[:added]]))
            shared = len(tokens) - dropped
            if not shared or 100 * shared < 75 * (len(tokens) + len(near) - shared):
                continue
            common = set(bands(len(tokens))) & set(bands(len(near)))
            found = 0
            for number in common:
                (a, a_cut, _), (b, b_cut, _) = (signatures(t, number) for t in (tokens, near))
                found += len(np.intersect1d(a[~a_cut], b)) + len(np.intersect1d(a, b[~b_cut]))
            assert found


def test_signatures_suffice_for_every_size():
    rng = np.random.default_rng(4)
    for size in range(1, 3000):
        tokens = rng.integers(0, 2**63, size).astype(np.uint64)
        for number in bands(size):
            assert signatures(tokens, number)[2].sum() >= needed(size, number)


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(5)
    for a, b in [(1, 1), (1, 2), (5, 9), (40, 30), (500, 90), (3000, 2900)]:
        pool = rng.integers(0, 2**64, 4000, dtype=np.uint64)
        x, y = (np.unique(rng.choice(pool, n)) for n in (a, b))
        assert at_most_shared(sketch(x), len(x), sketch(y), len(y)) >= len(np.intersect1d(x, y))


def test_definition():
    assert len(shingle_set("a b c d e f")) == 2
    assert len(shingle_set("a a a a a a a")) == 1
    assert not similar("", "")
