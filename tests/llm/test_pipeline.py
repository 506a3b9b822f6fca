"""The corpus pipeline: each stage over odd rows, and the whole of it against planted cases."""

import random

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from corpus_pipeline import STAGES, drop_contaminated, drop_repeated_lines, drop_similar, drop_toxic, to_token_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WIDE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in ("score", "ids", "hash", "a", "component_id", "removed_chunks")],
    ]
)


def words(rng, n, prefix="w"):
    return [f"{prefix}{rng.randint(0, 3000)}" for _ in range(n)]


class Corpus:
    """Tables in a folder: plain prose, and whatever a test plants."""

    def __init__(self, spark, folder, extra=(), plain=240, seed=0):
        rng = random.Random(seed)
        rows, labels = [], []
        for i in range(plain):
            body, bad = words(rng, 60), i % 6 == 0
            if bad:
                for _ in range(4):
                    body.insert(rng.randint(0, 60), rng.choice(("idiotic", "moronic", "lowlifes")))
            rows.append((i, " ".join(body)))
            labels.append((i, 1, int(bad)))
        self.items = [(k, " ".join(words(rng, 30, "item"))) for k in range(5)]
        self.spark, self.folder = spark, str(folder)
        self.rows = rows + list(extra)
        wide = [(*row, "en", "s", len(row[1] or ""), *[None] * 6) for row in self.rows]
        self.docs = spark.createDataFrame(wide, WIDE).repartition(4)
        self.docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame(self.items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    def toxic(self):
        return {i for i in range(240) if i % 6 == 0}


ODD = [(900, None), (901, ""), (902, " \n "), (None, "x y z"), (903, "tie one two"), (903, "tie one two"), (904, "é\n" * 3)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return Corpus(spark, tmp_path_factory.mktemp("odd"), [*ODD, (905, "long words " * 40_000 + "x" * 30_000)])


@pytest.mark.parametrize(("name", "stage"), STAGES)
def test_odd_rows_do_not_break_a_stage(spark, odd, name, stage):
    made = stage(spark, odd.docs, odd.folder)
    rows = made.collect()
    ids = [row["doc_id"] for row in rows]
    assert 900 in ids and 905 in ids and None in ids
    if name != "bpe":
        assert made.columns == odd.docs.columns
    if name not in ("ngram_join", "toxicity"):
        assert len(rows) == len(odd.rows)


@pytest.mark.parametrize(("name", "stage"), STAGES)
def test_an_empty_table_passes_a_stage(spark, odd, name, stage):
    made = stage(spark, odd.docs.limit(0), odd.folder)
    assert made.collect() == []


def test_toxic_documents_go(spark, tmp_path):
    corpus = Corpus(spark, tmp_path)
    kept = {row["doc_id"] for row in drop_toxic(spark, corpus.docs, corpus.folder).collect()}
    assert len(kept & corpus.toxic()) <= 2
    assert len(kept - corpus.toxic()) == 200


def test_repeated_chunks_go_and_the_count_follows(spark, tmp_path):
    lines = "\n".join(f"line number {i} of a passage" for i in range(40))
    corpus = Corpus(spark, tmp_path, [(500, f"{lines}\nfirst end"), (501, f"{lines}\nsecond end"), (502, lines)])
    kept = {row["doc_id"]: row for row in drop_repeated_lines(spark, corpus.docs, corpus.folder).collect()}
    assert kept[500]["text"] == f"{lines}\nfirst end"
    assert len(kept[501]["text"]) < len(lines) / 2 and kept[501]["text"].endswith("second end")
    assert all(row["n_chars"] == len(row["text"]) for row in kept.values())


def test_one_of_each_group_stays(spark, tmp_path):
    rng = random.Random(5)
    base = words(rng, 100, "copy")
    group = [(600 + k, " ".join([*base[:k], f"edit{k}", *base[k + 1 :]])) for k in range(20)]
    corpus = Corpus(spark, tmp_path, [*group, (700, " ".join(base)), (701, " ".join(base).upper())])
    kept = {row["doc_id"] for row in drop_similar(spark, corpus.docs, corpus.folder).collect()}
    assert {i for i in kept if i >= 240} == {600}
    assert len(kept) == 241


def test_documents_with_benchmark_passages_go(spark, tmp_path):
    corpus = Corpus(spark, tmp_path)
    rng = random.Random(6)
    planted = [(800 + k, " ".join([*words(rng, 20), item, *words(rng, 20)])) for k, item in corpus.items]
    docs = corpus.docs.unionByName(
        spark.createDataFrame([(*row, "en", "s", len(row[1]), *[None] * 6) for row in planted], WIDE)
    )
    kept = {row["doc_id"] for row in drop_contaminated(spark, docs, corpus.folder).collect()}
    assert kept == {i for i, _ in corpus.rows}


def test_texts_become_ids_that_decode_to_them(spark, odd):
    rows = to_token_ids(spark, odd.docs, odd.folder).collect()
    expected = sorted((i or -1, text or "") for i, text in odd.rows)
    assert sorted((row["doc_id"] or -1, row["text"]) for row in rows) == expected
    assert all(len(row["ids"]) == 4 * row["n_tokens"] for row in rows)


def test_the_whole_pipeline(spark, tmp_path):
    """The stages one after the other, each on what the one before kept."""
    rng = random.Random(7)
    base = words(rng, 80, "copy")
    corpus = Corpus(spark, tmp_path, [(600, " ".join(base)), (601, " ".join([*base[:-1], "end"])), (602, None)])
    by_hand = corpus.docs.select(COLUMNS)
    for _, stage in STAGES:
        by_hand = spark.createDataFrame(stage(spark, by_hand, corpus.folder).collect(), by_hand.schema) if stage is not to_token_ids else stage(spark, by_hand, corpus.folder)
    made = corpus_pipeline.run(spark, corpus.folder)
    figures = [sorted((r["doc_id"], r["n_tokens"], r["text"]) for r in frame.collect()) for frame in (made, by_hand)]
    assert figures[0] == figures[1]
    ids = {row[0] for row in figures[0]}
    assert 600 in ids and 601 not in ids and 602 in ids
    assert len(ids & corpus.toxic()) <= 2
