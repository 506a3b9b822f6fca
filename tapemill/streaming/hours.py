"""Hours straight from trades, in one query: minute windows, and hour windows over them.

Rows come out once, when they are final: a minute when the watermark passes its end, an hour when its last minute has
come out. So an hour is not rewritten as it fills; what it lacks against the hourly job is the hour that is still open.

A feed that falls silent leaves its last windows open. A heartbeat, a record with a time and nothing else, moves the
watermark on without counting as a trade.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapemill.functions import event_time, usable_time
from tapemill.functions.temporal import FIRST_MS
from tapemill.operators.bars import hour_groups, minute_groups
from tapemill.operators.trades import decode_records
from tapemill.streaming.minutes import WATERMARK, start_query


def heartbeat(time_ms: Column) -> Column:
    """Topic record that moves the watermark to this time, less the allowance."""
    return F.to_json(F.struct(time_ms.cast("bigint").alias("ts"))).cast("binary")


def timed_trades(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Streaming trades under a watermark that heartbeats move, too."""
    decoded = decode_records(messages)
    beats = F.col("symbol").isNull() & F.col("price").isNull() & F.col("qty").isNull() & usable_time(F.col("ts"))
    known = decoded.where(F.col("usable") | beats).withColumn("event_time", event_time(F.col("ts")))
    # A comparison with the time is not moved below the watermark, so the watermark sees heartbeats; every usable
    # time is later than this one, and a heartbeat's comparison is null.
    earliest = F.when(F.col("usable"), F.timestamp_millis(F.lit(FIRST_MS)))
    return known.withWatermark("event_time", watermark).where(F.col("event_time") >= earliest)


def hour_updates(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Streaming hours, each once, when it is final. The mean is the mean of the minute means."""
    return hour_groups(minute_groups(timed_trades(messages, watermark)))


def start_hour_stream(
    messages: DataFrame,
    upsert: Callable[[DataFrame], None],
    checkpoint: str,
    watermark: str = WATERMARK,
    available_now: bool = False,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Hand every hour to `upsert` when it is final. A replayed micro-batch replaces the same keys."""
    writer = (
        hour_updates(messages, watermark)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _epoch: upsert(batch))
    )
    return start_query(writer, messages.sparkSession, available_now, processing_time, state_partitions)
