"""Gaps in a feed, symbol by symbol: one live symbol does not hide a dead one."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapemill.functions import instant, since
from tapemill.functions.temporal import Now
from tapemill.operators.quality import DataQualityError
from tapemill.operators.timerange import from_time

# Fixed value: a feed is stale when no minute started for so long; the freshness gate has the same.
STALE = "30 MINUTES"


def _runs(bars: DataFrame, stale: str) -> DataFrame:
    """First and last minute of each run of a symbol's minutes in which no step is longer than `stale`.

    Session windows find the runs. A step of just `stale` is no gap, so the windows get the least more.
    """
    start = F.col("window_start_ts")
    run = F.session_window("window_start_ts", f"{stale} 1 MICROSECOND")
    return bars.groupBy("symbol", run.alias("run")).agg(F.min(start).alias("first"), F.max(start).alias("last"))


def outages(bars: DataFrame, now: Now = None, stale: str = STALE) -> DataFrame:
    """(symbol, silent_from, silent_until, ongoing, silent_minutes) of every gap of more than `stale`.

    `silent_from` is the end of the last minute before the gap, `silent_until` the start of the first one after it;
    a gap that lasts until `now` is ongoing and has no end. Minutes that start after `now` are not seen. What came before
    a symbol's first minute is no gap.
    """
    clock = instant(now)
    seen = bars.where(F.col("window_start_ts") <= clock)
    after = F.lead("first").over(Window.partitionBy("symbol").orderBy("first"))
    gaps = _runs(seen, stale).select("symbol", "last", after.alias("silent_until"))
    late = F.col("silent_until").isNotNull() | (F.col("last") < clock - F.expr(f"INTERVAL {stale}"))
    silent_from = F.col("last") + F.expr("INTERVAL 1 MINUTE")
    until = F.coalesce("silent_until", clock)
    return gaps.where(late).select(
        "symbol",
        silent_from.alias("silent_from"),
        "silent_until",
        F.col("silent_until").isNull().alias("ongoing"),
        _minutes(until, silent_from).alias("silent_minutes"),
    )


def _minutes(until: Column, begin: Column) -> Column:
    return F.timestamp_diff("MINUTE", begin, until)


def symbol_freshness(bars: DataFrame, now: Now = None, stale: str = STALE) -> DataFrame:
    """(symbol, last_window, fresh): the last minute of every symbol, and whether it started in the last `stale`."""
    clock = instant(now)
    seen = bars.where(F.col("window_start_ts") <= clock)
    last = seen.groupBy("symbol").agg(F.max("window_start_ts").alias("last_window"))
    return last.withColumn("fresh", F.col("last_window") >= clock - F.expr(f"INTERVAL {stale}"))


def require_symbols_fresh(bars: DataFrame, now: Now = None, stale: str = STALE, known: str = "1 DAY") -> None:
    """Raise for symbols that traded within `known` and have gone stale; names a few of them."""
    dead = symbol_freshness(from_time(bars, since(now, known)), now, stale).where(~F.col("fresh"))
    names = [row["symbol"] for row in dead.orderBy("symbol").limit(5).collect()]
    if names:
        raise DataQualityError(f"no minute rows start in the last {stale.lower()} for: {', '.join(names)}")
