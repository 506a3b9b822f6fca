"""Trades counted once, however often they are published."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once_only(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """One of the trades that share symbol, id and window, with the window as `bucket` instead of `event_time`.

    Trades without an id all stay.

    On a stream the ids are state, kept as long as their window is open: the window is part of the key, so a
    copy that comes later is dropped with everything else that is late, and a late trade whose window is still
    open is kept, as by the aggregation. (Dropping by the trade's own time would lose it.) The state is dealt
    by id, so a symbol with most of the trades is no hot key. On a batch it is a plain distinct.

    A copy has the time of the first, as both come from one message; it cannot fall into another window.
    A stream may have one event-time column between stateful steps, so the window takes the place of the time.
    """
    named = trades.withColumn("trade_id", F.coalesce("trade_id", F.uuid()))
    bucket = F.window("event_time", width)
    windowed = named.withColumn("bucket", bucket).drop("event_time")
    return windowed.dropDuplicates(["symbol", "trade_id", "bucket"])
