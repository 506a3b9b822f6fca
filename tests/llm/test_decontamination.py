import random

import numpy as np
from pyspark.sql import functions as F

from tapemill.llm import decontamination
from tapemill.llm.decontamination import GAP, MATCH, MISMATCH, align, benchmark_matches


def words(rng, n):
    return [f"v{rng.randint(0, 3000)}" for _ in range(n)]


def matches(docs, benchmark):
    found = docs.select("doc_id", F.explode(benchmark_matches(docs, benchmark)).alias("m")).select("doc_id", "m.*")
    return {(row["doc_id"], row["item_id"]): row for row in found.collect()}


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_copies_and_edited_copies(spark, documents):
    rng = random.Random(1)
    benchmark = [words(rng, rng.randint(15, 60)) for _ in range(40)]
    rows, planted = [], set()
    for i in range(200):
        own = words(rng, 120)
        if i % 2:
            item = benchmark[i % 40]
            rate = (0, 0.1, 0.2)[i % 3]
            item = [w if rng.random() >= rate else "other" for w in item]
            own[50:50] = item
            planted.add((i, i % 40))
        rows.append((i, " ".join(own).title()))
    found = matches(documents(rows), items(spark, [(k, " ".join(b)) for k, b in enumerate(benchmark)]))
    assert set(found) <= planted and len(found) >= 0.97 * len(planted)
    exact = [row for (i, _), row in found.items() if i % 3 == 0]
    assert all(row["score"] == 1.0 and row["first_word"] == 50 for row in exact)


def test_an_item_copied_everywhere_is_still_found(spark, documents):
    item = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(i, f"{i} a b {item} c d {i}") for i in range(50)]
    assert len(matches(documents(rows), items(spark, [(1, item)]))) == 50


def test_exact_copies_of_short_items(spark, documents):
    rng = random.Random(5)
    benchmark = [[f"item{k}x{i}" for i in range(n)] for k, n in enumerate([3, 3, 4, 4, *[5] * 10, 6])]
    rows = [(k, " ".join(words(rng, 40) + item + words(rng, 40))) for k, item in enumerate(benchmark)]
    found = matches(documents(rows), items(spark, [(k, " ".join(item)) for k, item in enumerate(benchmark)]))
    assert set(found) == {(k, k) for k in range(len(benchmark))}
    assert all(row["score"] == 1.0 for row in found.values())


def test_excerpts_of_long_items(spark, documents):
    rng = random.Random(6)
    benchmark = [[f"item{k}x{i}" for i in range(n)] for k, n in enumerate([59, 300, 300, 300])]
    cuts = [(20, 40), (0, 100), (150, 163), (290, 300)]
    rows = [(k, " ".join(words(rng, 90) + benchmark[k][a:b] + words(rng, 90))) for k, (a, b) in enumerate(cuts)]
    found = matches(documents(rows), items(spark, [(k, " ".join(item)) for k, item in enumerate(benchmark)]))
    # The last is shorter than an excerpt.
    spans = {i: (row["first_word"], row["end_word"]) for (i, _), row in found.items()}
    assert spans == {0: (90, 110), 1: (90, 190), 2: (90, 103)}


def test_edge_rows(spark, documents):
    item = " ".join(words(random.Random(2), 30))
    rows = [(1, None), (2, ""), (3, "x y"), (4, item), (4, item), (None, item), (5, "z " * 50_000 + item)]
    benchmark = items(spark, [(1, None), (2, ""), (3, "x y"), (4, item), (5, item)])
    docs = documents(rows)
    found = docs.select("doc_id", F.explode(benchmark_matches(docs, benchmark)).alias("m")).select("doc_id", "m.item_id")
    expected = [(i, k) for i in (4, 4, None, 5) for k in (4, 5)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert matches(docs, items(spark, [])) == {}
    assert matches(documents([]), benchmark) == {}


def test_a_large_benchmark_is_taken_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "PART_WORDS", 50)
    rng = random.Random(3)
    benchmark = [" ".join(words(rng, 20)) for _ in range(7)]
    docs = documents([(k, f"a b c {b} d e") for k, b in enumerate(benchmark)])
    assert set(matches(docs, items(spark, list(enumerate(benchmark))))) == {(k, k) for k in range(7)}


def plain_alignment(item, window):
    best, table = 0, np.zeros((len(item) + 1, len(window) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(window, 1):
            step = MATCH if a == b else MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] + GAP, table[i, j - 1] + GAP)
            best = max(best, table[i, j])
    return best


def test_alignment_scores():
    rng = np.random.default_rng(4)
    for _ in range(200):
        item, window = rng.integers(1, 6, rng.integers(1, 12)), rng.integers(0, 6, rng.integers(0, 15))
        score, begin, end = align(item, window)
        assert score == plain_alignment(item, window)
        assert 0 <= begin <= end <= len(window)
        if score:
            assert plain_alignment(item, window[begin:end]) == score
