"""Keyed upsert into a table of a catalog whose format supports MERGE."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.functions.temporal import Now
from tapemill.operators.contract import conform_bars
from tapemill.schemas import KEYS


def merge_into(bars: DataFrame, table: str, now: Now = None) -> None:
    """Insert the rows; on an existing key replace all measures and `updated_at`. Atomic and repeatable.

    Prefer this to `BarTable` where there is such a table: its format keeps the versions, and its readers
    prune partitions without a list of them.
    """
    source = conform_bars(bars, now).alias("new")
    same = [F.col(f"{table}.{key}") == F.col(f"new.{key}") for key in KEYS]
    source.mergeInto(table, same[0] & same[1]).whenMatched().updateAll().whenNotMatched().insertAll().merge()
