import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for what they return.
        T.StructField("score", T.StringType()),
        T.StructField("n_tokens", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("_chunks", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents frame from (doc_id, text) or (doc_id, text, lang); with columns that clash, all null."""

    def make(rows, partitions=3):
        wide = [(*row, *[None] * (len(DOCUMENT) - len(row))) for row in rows]
        return spark.createDataFrame(wide, DOCUMENT).repartition(partitions)

    return make
