"""The continuous job: trade messages to minute bars, upserted per micro-batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tapemill.operators.bars import minute_bars
from tapemill.operators.trades import parse_trades
from tapemill.streaming.once import once_only

# Lateness allowance and window width.
WATERMARK = "2 minutes"
WIDTH = "1 minute"


def minute_updates(
    messages: DataFrame, watermark: str = WATERMARK, width: str = WIDTH, once: bool = False
) -> DataFrame:
    """Streaming bars. A trade is dropped once its window ends at or before the watermark.

    `once` counts trades of one id once; without it a batch that was published twice counts twice.
    """
    trades = parse_trades(messages, identified=once).withWatermark("event_time", watermark)
    return minute_bars(once_only(trades, width) if once else trades, width)


def start_minute_stream(
    messages: DataFrame,
    upsert: Callable[..., None],
    checkpoint: str,
    watermark: str = WATERMARK,
    width: str = WIDTH,
    available_now: bool = False,
    processing_time: str | None = None,
    state_partitions: int | None = None,
    once: bool = False,
    numbered: bool = False,
) -> StreamingQuery:
    """Emit the full current value of every touched window and hand it to `upsert`.

    A replayed micro-batch replaces the same keys, so the table is right after a restart on the same
    checkpoint. Without one, a minute already half read would be replaced by its rest: rebuild such minutes
    from a batch over whole minutes.

    `state_partitions` is the shuffle width and the number of state stores. The first start fixes it for the
    life of the checkpoint; the session's spark.sql.shuffle.partitions is the default. `once` adds state of its
    own, so it too is fixed by the first start. `numbered` gives `upsert` the number of each batch, too, which a
    replay repeats.
    """
    writer = (
        minute_updates(messages, watermark, width, once)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert if numbered else lambda batch, _epoch: upsert(batch))
    )
    return start_query(writer, messages.sparkSession, available_now, processing_time, state_partitions)


def start_query(
    writer: DataStreamWriter,
    spark: SparkSession,
    available_now: bool = False,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start with the trigger and, for its life, the shuffle width that are asked for."""
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    conf, width_key = spark.conf, "spark.sql.shuffle.partitions"
    session_width = conf.get(width_key)
    conf.set(width_key, state_partitions or session_width)
    try:
        return writer.start()
    finally:
        # The query runs on a copy of the session's settings taken at its start.
        conf.set(width_key, session_width)
