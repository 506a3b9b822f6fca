"""Time range over a bar table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.functions import utc_date, utc_hour


def from_time(bars: DataFrame, lower: Column) -> DataFrame:
    """Rows whose window starts at `lower` or later; there is no upper bound.

    Tables are partitioned by UTC date (and hour); Spark cannot derive those bounds from the window start, so
    they are added where the columns exist.
    """
    bounded = bars.where(F.col("window_start_ts") >= lower)
    if "window_hour" in bars.columns:
        day, hour = utc_date(lower), utc_hour(lower)
        return bounded.where(
            (F.col("window_date") > day) | ((F.col("window_date") == day) & (F.col("window_hour") >= hour))
        )
    if "window_date" in bars.columns:
        return bounded.where(F.col("window_date") >= utc_date(lower))
    return bounded


def within(bars: DataFrame, lower: Column, upper: Column) -> DataFrame:
    """Rows whose window starts at `lower` or later and before `upper`."""
    bounded = from_time(bars, lower).where(F.col("window_start_ts") < upper)
    if "window_date" not in bars.columns:
        return bounded
    day, last = F.col("window_date"), utc_date(upper)
    if "window_hour" in bars.columns:
        return bounded.where((day < last) | ((day == last) & (F.col("window_hour") <= utc_hour(upper))))
    return bounded.where(day <= last)
