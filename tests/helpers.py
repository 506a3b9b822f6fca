from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tapemill.schemas import BAR_SCHEMA, TRADE_SCHEMA

NOON = datetime(2024, 3, 5, 12, 0, tzinfo=timezone.utc)


def ms(moment):
    return int(moment.timestamp() * 1000)


def at(**delta):
    return NOON + timedelta(**delta)


def trades(spark, rows):
    """(time, symbol, price, qty) tuples as trades with their event time."""
    frame = spark.createDataFrame([(ms(t), s, p, q, "buy") for t, s, p, q in rows], TRADE_SCHEMA)
    return frame.withColumn("event_time", F.timestamp_millis("ts"))


def bars(spark, rows, updated_at=NOON):
    """(symbol, window start, count, volume, mean[, min, max]) tuples as table rows."""
    full = []
    for symbol, start, count, volume, mean, *span in rows:
        low, high = span or (mean, mean)
        full.append((symbol, start, count, *[Decimal(str(v)) for v in (volume, mean, low, high)], updated_at))
    return spark.createDataFrame(full, BAR_SCHEMA)


def minutes_before(spark, means, symbol="A", now=NOON):
    """One bar per minute, the last one starting a minute before `now`."""
    return bars(
        spark,
        [(symbol, now - timedelta(minutes=len(means) - i), 1, 1, mean) for i, mean in enumerate(means)],
    )


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
