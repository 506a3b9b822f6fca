"""Scan of a minute or hour table held in a relational database."""

from pyspark.sql import DataFrame, SparkSession

from tapemill.schemas import BAR_SCHEMA


def read_bars_jdbc(spark: SparkSession, table: str, **options: str) -> DataFrame:
    """Filters on symbol and window start are pushed into the database.

    Pass partitionColumn/lowerBound/upperBound/numPartitions to read a long history in parallel.
    """
    frame = spark.read.format("jdbc").options(dbtable=table, **options).load()
    return frame.select([frame[field.name].cast(field.dataType).alias(field.name) for field in BAR_SCHEMA])
