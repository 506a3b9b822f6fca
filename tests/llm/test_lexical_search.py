import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tapemill.llm import lexical_search
from tapemill.llm.lexical_search import terms_of, top_documents

SEPARATORS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded(text):
    return SEPARATORS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def brute_force(docs, items, top=10):
    held = [(i, Counter(folded(text or ""))) for i, text in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = set()
    for item, text in set(items):
        scores = []
        for i, counts in held:
            m = 25 + (75 * sum(counts.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in folded(text or "")
                if t in counts
            )
            if score > 0 and i is not None:
                scores.append((-score, i))
        rows |= {(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top])}
    return rows


def items_frame(spark, rows):
    return spark.createDataFrame(
        [(*row, None, None) for row in rows], "item_id long, text string, doc_id string, rank string"
    )


def result(docs, items, **options):
    rows = [tuple(row) for row in top_documents(docs, items, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_terms():
    text = "Ab-cD\x7f1 É x y_z[Q]`{ÀÉ|0~9"
    assert [t.decode() for t in terms_of(text.encode())] == folded(text)
    assert terms_of(b"") == terms_of(b" -_\x00") == []


@pytest.mark.parametrize("bucket", [4, 64, 4096])
def test_against_brute_force(spark, documents, monkeypatch, bucket):
    monkeypatch.setattr(lexical_search, "BUCKET_ROWS", bucket)
    rng = random.Random(bucket)
    word = lambda: f"W{int(rng.paretovariate(0.7)) % 300}"
    texts = [" ".join(word() for _ in range(rng.choice((1, 3, 8, 40, 200)))) for _ in range(400)]
    items = [" ".join(word() for _ in range(rng.choice((1, 5, 30)))) for _ in range(25)]
    items += [" ".join(texts[7].split()[:20] * 2), texts[9]]
    # A third of the rows are copies of one text; items are planted whole.
    texts += [texts[3]] * 200 + [f"{item} {texts[5]}" for item in items]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    items = list(enumerate(items))
    assert result(documents(docs, 5), items_frame(spark, items)) == brute_force(docs, items)


def test_blocks_of_items(spark, documents, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 40)
    rng = random.Random(1)
    docs = [(i, " ".join(f"w{rng.randint(0, 30)}" for _ in range(12))) for i in range(60)]
    items = [(i, " ".join(f"w{rng.randint(0, 30)}" for _ in range(4))) for i in range(9)] + [(9, "w1 " * 100)]
    assert result(documents(docs), items_frame(spark, items)) == brute_force(docs, items)


def test_edge_rows(spark, documents):
    long = "alpha " * 30_000 + "omega"
    docs = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (4, "-- --"), (None, "alpha gamma"), (5, long)]
    docs += [(6, "beta é"), (7, "BETA É"), (-8, "delta")]
    items = [(1, "Alpha beta"), (1, "Alpha beta"), (1, "beta"), (2, None), (3, "--"), (4, "unheard"), (None, "é omega")]
    found = [tuple(r) for r in top_documents(documents(docs), items_frame(spark, items)).collect()]
    assert set(found) == brute_force(docs, items)
    # Both rows of document 1 are ranked.
    assert sum(r[2] == 1 for r in found) == 4
    assert {r[0] for r in found} == {1, None}


def test_empty_tables(spark, documents):
    assert result(documents([]), items_frame(spark, [(1, "a")])) == set()
    assert result(documents([(1, "a")]), items_frame(spark, [])) == set()
    assert result(documents([(1, None)]), items_frame(spark, [(1, "a")])) == set()
    assert top_documents(documents([]), items_frame(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]


def test_bucket_keeps_all_that_reach_the_limit():
    rng = np.random.default_rng(5)
    terms = 12
    for _ in range(50):
        rows = [np.sort(rng.choice(terms, rng.integers(1, 8), replace=False)) for _ in range(40)]
        values = [rng.integers(1, 1000, len(r)) for r in rows]
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        lengths = np.array([math.sqrt(float((v.astype(float) ** 2).sum())) for v in values])
        bucket = lexical_search.Bucket(
            np.arange(40), lengths, starts, np.concatenate(rows), np.concatenate(values), terms
        )
        slots = rng.choice(terms, 4, replace=False)
        counts = rng.integers(1, 4, 4)
        whole = {
            i: int(sum(c * v[r == s].sum() for s, c in zip(slots, counts, strict=True)))
            for i, (r, v) in enumerate(zip(rows, values, strict=True))
        }
        least = int(rng.integers(1, 3000))
        docs, scores = bucket.search(slots, counts, least, np.zeros(terms, np.int64))
        assert dict(zip(docs.tolist(), scores.tolist(), strict=True)) == {i: s for i, s in whole.items() if s >= least}
