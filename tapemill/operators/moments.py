"""Volatility over long ranges from moments kept per hour, without reading minutes.

An hour keeps the number of its minute means, their mean, the sum of their squared deviations from it, and the lowest and
highest price. Two hours merge exactly into the moments of both (the deviations of each, and those of the two means
from the common one), so a range of any length costs one row per symbol and hour instead of sixty.
"""

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapemill.functions import floor_hour, instant, utc_date
from tapemill.operators.timerange import within
from tapemill.schemas import PRICE_TYPE

HOUR = timedelta(hours=1)
_PRICE = PRICE_TYPE.simpleString()
MOMENTS_SCHEMA = (
    "symbol string, hour timestamp, minutes bigint, mean double, sq_dev double, "
    f"price_min {_PRICE}, price_max {_PRICE}, hour_date date"
)
_FIGURES = ["minutes", "mean", "sq_dev", "price_min", "price_max"]


def _moments(bars: DataFrame, *by: Column) -> DataFrame:
    mean = F.col("price_avg").cast("double")
    return bars.groupBy("symbol", *by).agg(
        F.count(mean).alias("minutes"),
        F.avg(mean).alias("mean"),
        (F.var_pop(mean) * F.count(mean)).alias("sq_dev"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
    )


def hour_moments(bars: DataFrame) -> DataFrame:
    """Moments of every symbol and hour of a minute table."""
    return _moments(bars, floor_hour(F.col("window_start_ts")).alias("hour")).select("symbol", "hour", *_FIGURES)


def merged_moments(moments: DataFrame, *by: str) -> DataFrame:
    """Moments of all rows of a group together; groups are those of `by`, by default symbols."""
    by = by or ("symbol",)
    whole = moments.groupBy(*by).agg(
        (F.sum(F.col("minutes") * F.col("mean")) / F.sum("minutes")).alias("_mean"),
    )
    off = F.col("mean") - F.col("_mean")
    return (
        moments.join(whole, list(by))
        .groupBy(*by)
        .agg(
            F.sum("minutes").alias("minutes"),
            F.first("_mean").alias("mean"),
            F.sum(F.col("sq_dev") + F.col("minutes") * off * off).alias("sq_dev"),
            F.min("price_min").alias("price_min"),
            F.max("price_max").alias("price_max"),
        )
    )


def volatility(merged: DataFrame) -> DataFrame:
    """Sample deviation of the minute means (null below two), and (max - min) / mean in percent (null at mean 0)."""
    spread = (F.col("price_max") - F.col("price_min")).cast("double")
    deviation = F.when(F.col("minutes") > 1, F.sqrt(F.col("sq_dev") / (F.col("minutes") - 1)))
    rate = F.try_divide(spread, "mean") * 100
    return merged.select("symbol", "minutes", deviation.alias("std_dev"), rate.alias("vol_rate"))


def write_moments(bars: DataFrame, folder: str) -> None:
    """Keep the moments of the dates that `bars` has; a date's rows are replaced, so `bars` holds whole dates."""
    dated = hour_moments(bars).withColumn("hour_date", utc_date(F.col("hour")))
    writer = dated.hint("rebalance", "hour_date").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("hour_date").parquet(folder)


def read_moments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MOMENTS_SCHEMA).parquet(folder)


def volatility_between(moments: DataFrame, bars: DataFrame, first: datetime, last: datetime) -> DataFrame:
    """`volatility` of the minutes that start at `first` or later and before `last` (UTC if they name no zone).

    Whole hours come from the moments, by their stored dates; minutes are read for an hour that the range cuts, two at
    the most.
    """
    begin, end = (time if time.tzinfo else time.replace(tzinfo=timezone.utc) for time in (first, last))
    # The first whole hour begins at `begin` or after it, the last one ends at `end` or before it.
    low, high = _floor(begin + HOUR - timedelta(microseconds=1)), _floor(end)
    high = max(low, high)
    hour = F.col("hour")
    dates = F.col("hour_date").between(utc_date(instant(low)), utc_date(instant(high)))
    parts = [moments.where(dates & (hour >= instant(low)) & (hour < instant(high))).select("symbol", *_FIGURES)]
    for lower, upper in ((begin, min(low, end)), (high, end)):
        if lower < upper:
            parts.append(_moments(within(bars, instant(lower), instant(upper))).select("symbol", *_FIGURES))
    return volatility(merged_moments(reduce(DataFrame.unionByName, parts)))


def _floor(time: datetime) -> datetime:
    return time.replace(minute=0, second=0, microsecond=0)
