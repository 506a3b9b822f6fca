import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapemill.llm import language_id, toxicity
from tapemill.llm.language_id import UNKNOWN, code_matrix
from tapemill.llm.ngrams import gram_slots

SYLLABLES = {"aa": "ba be bo ka ke", "bb": "stri cht ung ver", "cc": "que aux ment oi", "dd": "cion ez illo ar"}


def sentence(rng, language, n=30):
    return " ".join("".join(rng.choices(SYLLABLES[language].split(), k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    languages = sorted(SYLLABLES)
    return [(i, sentence(rng, languages[i % 4], rng.choice((3, 30, 200))), languages[i % 4]) for i in range(600)]


def predictions(docs, model):
    found = language_id.identify(docs, model)
    return docs.select("doc_id", "lang", language_id.held_out().alias("held_out"), found.alias("f")).select("*", "f.*")


def test_languages_of_held_out_rows(documents, labelled):
    docs = documents(labelled)
    rows = predictions(docs, language_id.train(docs)).collect()
    held = [row for row in rows if row["held_out"]]
    assert {row["doc_id"] for row in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([row["lang"] == row["lang_pred"] for row in held]) > 0.98
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_edge_texts(documents, labelled):
    docs = documents(labelled)
    model = language_id.train(docs)
    odd = documents([(1, None), (2, ""), (3, "123 !?"), (4, "ba"), (5, "que " * 400_000), (5, "ba"), (None, "ba")])
    found = {}
    for row in predictions(odd, model).collect():
        found.setdefault(row["doc_id"], set()).add((row["lang_pred"], row["score"] > 0))
    assert found[1] == found[2] == found[3] == {(UNKNOWN, False)}
    assert found[4] == found[None] == {("aa", True)}
    assert found[5] == {("cc", True), ("aa", True)}


@pytest.mark.parametrize("rows", [[], [(1, "text", None)], [(4, "only", "aa")], [(4, None, "aa")]])
def test_little_to_learn_from(documents, rows):
    model = language_id.train(documents(rows))
    row = predictions(documents([(9, "some text")]), model).first()
    assert row["lang_pred"] == ("aa" if rows and rows[0][1:] == ("only", "aa") else UNKNOWN)


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 20, 100])
def test_codewords_differ(n):
    codes = code_matrix(n)
    assert len({tuple(row) for row in codes.tolist()}) == n
    assert (np.abs(codes.sum(axis=0)) < n).all()


def test_blocks_do_not_change_the_grams(monkeypatch):
    text = "Straße " * 50
    whole = np.sort(np.concatenate(list(gram_slots(text, (1, 3, 5), 12))))
    monkeypatch.setattr("tapemill.llm.ngrams.BLOCK", 7)
    assert (np.sort(np.concatenate(list(gram_slots(text, (1, 3, 5), 12)))) == whole).all()


@pytest.fixture(scope="module")
def toxic():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        words, bad = sentence(rng, rng.choice("aa bb".split()), 60).split(), i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randint(0, 60), rng.choice(("idiotic", "moronic", "lowlife")) + rng.choice(("", "s", "ly")))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxic_held_out_rows(spark, documents, toxic):
    rows, labels = toxic
    docs, marks = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.toxicity(docs, model).alias("s"))
    held = [row for row in scored.collect() if row["held_out"]]
    assert {row["doc_id"] for row in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    right = [(row["s"] >= toxicity.THRESHOLD) == (row["doc_id"] % 5 == 0) for row in held]
    assert np.mean(right) > 0.98
    odd = documents([(1, None), (2, ""), (3, "ba " * 300_000 + "idiotic moronic lowlifes"), (3, "ba"), (None, "ba")])
    found = {}
    for row in odd.select("doc_id", toxicity.toxicity(odd, model).alias("s")).collect():
        found.setdefault(row["doc_id"], []).append(row["s"])
    assert found[1] == found[2] and found[1][0] < 0.5 and max(found[3]) > 0.7 and found[None] == [min(found[3])]


@pytest.mark.parametrize(
    ("labels", "score"),
    [([], 0.0), ([(1, 1, None)], 0.0), ([(1, 1, 0)], 0.0), ([(1, 1, 1)], 1.0), ([(1, 1, 0), (1, 1, 1), (1, 1, 7)], 1.0)],
)
def test_labels_of_one_kind(spark, documents, labels, score):
    docs = documents([(i, "some text") for i in range(5)])
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert docs.select(F.round(toxicity.toxicity(docs, model), 3).alias("s")).distinct().collect() == [(score,)]
