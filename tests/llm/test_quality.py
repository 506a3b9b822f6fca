import random

import numpy as np
import pytest
from __spark_entry__ import queries

from tapemill.llm import quality
from tapemill.llm.quality import QualityModel, features, score, slots_of
from tapemill.llm.toxicity import held_out


def labels_frame(spark, rows):
    return spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, quality int, text string")


def corpus(n, seed=0):
    """Prose of invented words, and texts that repeat words or carry marks."""
    rng = random.Random(seed)
    syllables = ["ta", "re", "on", "the", "ing", "er", "and", "lo", "mi", "su"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 60))]
        good = rng.random() < 0.7
        if not good:
            words = [w + "&&&" for w in words] if rng.random() < 0.5 else [w for w in words for _ in range(3)]
        rows.append((i, " ".join(words), int(good)))
    return rows


def scores(spark, documents, docs, labels):
    frame = documents(docs)
    model = quality.train(frame, labels_frame(spark, labels))
    made = frame.select("doc_id", "text", quality.quality(frame, model).alias("score_"))
    return [(row["doc_id"], row["text"], row["score_"]) for row in made.collect()]


def test_learns_what_is_junk(spark, documents):
    rows = corpus(900)
    found = scores(spark, documents, [r[:2] for r in rows], [(i, good) for i, _, good in rows])
    of = {i: score for i, _, score in found}
    held = spark.createDataFrame([(i,) for i, *_ in rows], "doc_id long").where(held_out()).collect()
    right = [(of[row["doc_id"]] >= 0.5) == bool(rows[row["doc_id"]][2]) for row in held]
    assert len(right) > 200
    assert np.mean(right) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    rows = corpus(200)
    held = {r["doc_id"] for r in spark.createDataFrame([(r[0],) for r in rows], "doc_id long").where(held_out()).collect()}
    docs = [r[:2] for r in rows]
    plain = scores(spark, documents, docs, [(i, good) for i, _, good in rows])
    turned = scores(spark, documents, docs, [(i, 1 - good if i in held else good) for i, _, good in rows])
    assert sorted(plain) == sorted(turned)


def test_shards_share_the_work(spark, documents, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_ROWS", 100)
    rows = corpus(700, seed=4)
    found = scores(spark, documents, [r[:2] for r in rows], [(i, good) for i, _, good in rows])
    assert np.mean([(score >= 0.5) == bool(rows[i][2]) for i, _, score in found]) > 0.95


def test_edge_rows(spark, documents):
    rows = corpus(120)
    long = "lore " * 40_000 + "x" * 50_000
    extra = [(1000, None), (1001, ""), (1002, " \n"), (None, "lota"), (1003, long), (5, "another text"), (5, "another text")]
    labels = [(i, good) for i, _, good in rows] + [(1000, 0), (None, 1), (2, 7), (3, None), (4, 0), (4, 1)]
    found = scores(spark, documents, [r[:2] for r in rows] + extra, labels)
    assert len(found) == len(rows) + len(extra)
    assert all(0 <= score <= 1 for *_, score in found)
    empty = {score for i, _, score in found if i in (1000, 1001, 1002)}
    assert len(empty) == 1


def test_without_labels(spark, documents):
    docs = [(i, "some words") for i in range(4)]
    for labels, expected in (([], 0.0), ([(i, 1) for i in range(4)], 1.0), ([(i, 0) for i in range(4)], 0.0)):
        found = scores(spark, documents, docs, labels)
        assert [round(score, 6) for *_, score in found] == [expected] * 4
    assert scores(spark, documents, [], [(1, 1), (2, 0), (3, 1)]) == []


def test_score_is_the_softmax_of_the_mean_vector():
    rng = np.random.default_rng(0)
    model = QualityModel.fresh(0.6)
    model.outputs = rng.normal(size=model.outputs.shape).astype(np.float32)
    for text in ("one two two three", "one", "", "ein Wort é 日本 " * 30):
        slots, counts = features(text)
        mean = (counts / max(counts.sum(), 1)) @ model.vectors[slots]
        raw = model.outputs @ mean + model.constants
        expected = np.exp(raw[1]) / np.exp(raw).sum()
        assert score(text, model.weights(), model.offset()) == pytest.approx(expected, abs=1e-5)


def grams(text):
    """Features by name, from plain loops; a pair of equal words has one name."""
    words = text.split()
    found = [("word", w) for w in words]
    found += [("gram", f" {w} "[i : i + n]) for w in words for n in quality.SIZES for i in range(len(w) + 3 - n)]
    return found + [("pair", None if a == b else (a, b)) for a, b in zip(words, words[1:], strict=False)]


@pytest.mark.parametrize("block", [4, 9, 1 << 18])
def test_features(monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK", block)
    monkeypatch.setattr(quality, "_LOOKUP", {})
    monkeypatch.setattr(quality, "BITS", 40)
    text = "ab ab\tcab  x é日本🙂 ab, abcdefghijklmnop x x"
    slots = np.concatenate(list(slots_of(text)))
    expected = grams(text)
    assert len(slots) == len(expected)
    # As many distinct slots, met as often.
    assert sorted(np.unique(slots, return_counts=True)[1]) == sorted(expected.count(f) for f in set(expected))
    assert list(slots_of(" \n")) == []


def test_blocks_do_not_change_the_features(monkeypatch):
    text = " ".join(f"w{i % 37}é" for i in range(500))
    whole = features(text)
    monkeypatch.setattr(quality, "BLOCK", 50)
    monkeypatch.setattr(quality, "_LOOKUP", {})
    assert all((a == b).all() for a, b in zip(whole, features(text), strict=True))


def test_a_step_lowers_the_loss():
    model = QualityModel.fresh(0.5)
    slots, counts = np.array([1, 5, 9]), np.array([2, 1, 1])

    def loss():
        raw = model.outputs @ (counts / 4 @ model.vectors[slots]) + model.constants
        return -raw[1] + np.log(np.exp(raw).sum())

    before = loss()
    for _ in range(20):
        model.learn(1, slots, counts, 0.5)
    assert loss() < before


def test_held_out_rows_of_the_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    made = queries()["op12_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = made.join(labels, "doc_id").where("held_out").collect()
    assert made.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert np.mean([row["predicted"] == row["quality"] for row in rows]) > 0.95
