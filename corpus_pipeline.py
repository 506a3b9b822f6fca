"""Raw documents to token ids, in stages that each call one operator of the corpus package.

Each stage reads what the one before it wrote. All but the last return the columns of `documents`:

- toxicity: documents that the classifier rejects go.
- line_dedup: repeated multi-line chunks are cut out of texts; a document that had text and loses all of it goes.
- ngram_join: of each group of similar documents, the one with the smallest id stays.
- decontamination: documents with a benchmark passage go.
- bpe: texts become token ids; the result has doc_id, n_tokens, ids, and the text that they decode to.

`n_chars` follows the text. Rows without an id pass the first two stages and the fourth by their text alone, and
the third as they are. Rows that share an id are one document in the second and third stage.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapemill.llm import bpe_codec, decontamination, line_dedup, ngram_join, toxicity
from tapemill.llm.common import table
from tapemill.session import work_dir

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity(docs, model) < toxicity.THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A column of the documents' own that has the operator's name steps aside for it.
    names = [name if name.lower() != "removed_chunks" else _free(docs, name) for name in docs.columns]
    cut = line_dedup.remove_repeated_chunks(docs.toDF(*names))
    kept = cut.where((F.col("removed_chunks") == 0) | (F.col("text") != ""))
    changed = F.when(F.col("removed_chunks") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.withColumn("n_chars", F.coalesce(changed, "n_chars")).select(names).toDF(*docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    """The name with as many underscores before it as no column has."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_join.similar_documents(docs)
    later = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    return docs.join(later, "doc_id", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    matches = decontamination.benchmark_matches(docs, table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(matches) == 0)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    lexicon = bpe_codec.share_lexicon(spark, bpe_codec.frequent_words(docs), path)
    return bpe_codec.encode(docs, path, lexicon, decoded=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_similar),
    ("decontamination", drop_contaminated),
    ("bpe", to_token_ids),
]

# Toxicity is learned, and alignment and merging are procedures: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
