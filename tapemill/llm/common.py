"""What the corpus operators share: tables, intermediate results, work on Arrow batches."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tapemill.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(frame: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


# Bounds of an Arrow batch on its way to Python: rows, and bytes of each column.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def bound_batches(spark: SparkSession | None = None) -> None:
    """Lower the session's bounds of Arrow batches to BATCH: texts are long, and each task holds a few batches."""
    conf = (spark or SparkSession.active()).conf
    for name, most in BATCH.items():
        if not 0 < int(conf.get(name).rstrip("b")) <= most:
            conf.set(name, str(most))


@contextmanager
def narrow_batches(spark: SparkSession, rows: int = 10_000) -> Iterator[None]:
    """While an action over short rows runs, so many of them make a batch; the bound of bytes stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Arrow batches are turned into Python objects in parts of about so many bytes.
PART_BYTES = 4 << 20


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, batch.num_rows * PART_BYTES // max(batch.nbytes, 1))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def map_rows(
    frame: DataFrame,
    columns: list[str],
    schema: str,
    rows_of: Callable[[Iterator[dict[str, list]]], Iterator[list]],
    arrays: tuple[str, ...] = (),
) -> DataFrame:
    """`rows_of` gets the wanted columns of each Arrow batch as lists and yields lists of output columns.

    Those named in `arrays` it gets as Arrow arrays. Only `columns` are read, whatever else the frame has. An empty partition yields no rows.
    """
    bound_batches(frame.sparkSession)
    out = to_arrow_schema(T._parse_datatype_string(schema))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches for part in _parts(batch))
        read = [(name, i, name in arrays) for i, name in enumerate(columns)]
        lists = ({n: part.column(i) if plain else part.column(i).to_pylist() for n, i, plain in read} for part in parts)
        for made in rows_of(lists):
            yield pa.record_batch(
                [
                    column if isinstance(column, pa.Array) else pa.array(column, field.type)
                    for column, field in zip(made, out, strict=True)
                ],
                schema=out,
            )

    return frame.select(*columns).mapInArrow(work, schema)

