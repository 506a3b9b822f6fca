"""Freshness gate and ingest status."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.functions import since
from tapemill.functions.temporal import Now
from tapemill.operators.panels import panel_recent
from tapemill.operators.timerange import from_time


class DataQualityError(ValueError):
    """The minute table has gone stale."""


def freshness_report(bars: DataFrame, now: Now = None) -> DataFrame:
    """One row: how many minute rows, of any symbol, start in the last 30 minutes."""
    recent = from_time(bars, since(now, "30 MINUTES"))
    return recent.agg(F.count(F.lit(1)).alias("cnt")).withColumn("fresh", F.col("cnt") > 0)


def require_fresh(bars: DataFrame, now: Now = None) -> None:
    """Raise when there is no such row; stops at the first one found."""
    if from_time(bars, since(now, "30 MINUTES")).isEmpty():
        raise DataQualityError("no minute rows start in the last 30 minutes")


def ingest_status(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    """One row: healthy when the recent panel has any row, and the trades it counts."""
    totals = panel_recent(bars, now, symbol).agg(
        F.count(F.lit(1)).alias("minutes"), F.coalesce(F.sum("trade_cnt"), F.lit(0)).alias("recent_rows")
    )
    return totals.select(F.when(F.col("minutes") > 0, "ok").otherwise("no data").alias("status"), "recent_rows")
