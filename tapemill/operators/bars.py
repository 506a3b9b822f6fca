"""Window aggregation of trades and its re-aggregation to hours."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.functions import exact_mean_price, exact_volume, floor_hour, instant, table_price
from tapemill.functions.temporal import Now
from tapemill.operators.timerange import from_time
from tapemill.schemas import KEYS, MEASURES, PRICE_TYPE, VOLUME_TYPE


def minute_bars(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """One row per symbol and tumbling event-time window; the same code for a batch and for a stream.

    Trades that know their window, in a column `bucket`, are grouped by that.

    `price_avg` is the plain mean over trades, not weighted by quantity. Map-side partial aggregation
    leaves at most one row per window, symbol and task for the shuffle, however busy a symbol is.
    """
    return _started(minute_groups(trades, width))


def minute_groups(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """`minute_bars` with the window itself, as `bucket`: on a stream it carries the watermark on."""
    price, qty = F.col("price"), F.col("qty")
    bucket = F.col("bucket") if "bucket" in trades.columns else F.window("event_time", width).alias("bucket")
    return trades.groupBy(bucket, "symbol").agg(
        F.count(F.lit(1)).alias("trade_cnt"),
        exact_volume(qty).alias("volume_sum"),
        exact_mean_price(price).alias("price_avg"),
        table_price(F.min(price)).alias("price_min"),
        table_price(F.max(price)).alias("price_max"),
    )


def _started(groups: DataFrame) -> DataFrame:
    return groups.select("symbol", F.col("bucket.start").alias("window_start_ts"), *MEASURES)


def hour_bars(bars: DataFrame) -> DataFrame:
    """Hours from minutes. The mean is the mean of the minute means: every minute present weighs the same."""
    grouped = _rolled_up(bars, floor_hour(F.col("window_start_ts")).alias("hour"))
    return grouped.withColumnRenamed("hour", "window_start_ts").select(*KEYS, *MEASURES)


def hour_groups(minutes: DataFrame) -> DataFrame:
    """Hours from the minute windows of a stream. A window of windows: an hour closes after its last minute."""
    hour = F.window(F.window_time("bucket"), "1 hour").alias("hour")
    return _started(_rolled_up(minutes, hour).withColumnRenamed("hour", "bucket"))


def _rolled_up(minutes: DataFrame, hour: Column) -> DataFrame:
    return minutes.groupBy("symbol", hour).agg(
        F.sum("trade_cnt").alias("trade_cnt"),
        F.sum("volume_sum").cast(VOLUME_TYPE).alias("volume_sum"),
        F.avg("price_avg").cast(PRICE_TYPE).alias("price_avg"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
    )


def rollup_1h(bars: DataFrame, now: Now = None) -> DataFrame:
    """The previous and the current (possibly incomplete) hour, as the hourly job rewrites them."""
    this_hour = floor_hour(instant(now))
    span = from_time(bars, this_hour - F.expr("INTERVAL 1 HOUR"))
    return hour_bars(span.where(F.col("window_start_ts") < this_hour + F.expr("INTERVAL 1 HOUR")))
