"""Message sources: a Kafka topic, any file format standing in for it, and landed raw text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_trade_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded scan of any streaming source that carries messages in a `value` column."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_trade_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Trades topic. `starting_offsets` counts only while the query has no checkpoint.

    The topic is keyed by symbol, so a busy symbol fills one topic partition; `min_partitions` lets Spark
    read such a partition with several tasks.
    """
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    options |= {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    return read_trade_stream(spark, "kafka", **options)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Landed messages, one JSON text per line, as the same `value` column."""
    return spark.read.text(path)
