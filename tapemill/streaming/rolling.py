"""The rolling deviation of minute means as a stream: each minute's figure once, when the minute is final.

Two queries, as Spark does not chain a keyed state behind an aggregation: the first appends final minutes to a folder,
whose log of files makes that exactly once; the second reads them and keeps the last minutes of each symbol as state,
four of them for a window of five, a few dozen bytes whatever the trades. Minutes reach the state in time order: those of
one batch are sorted, and a minute that closes in a later batch is a later minute.
"""

from collections.abc import Callable, Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tapemill.operators.bars import minute_groups
from tapemill.operators.panels import ROLLING_ROWS
from tapemill.schemas import BAR_SCHEMA, KEYS, MEASURES
from tapemill.streaming.hours import timed_trades
from tapemill.streaming.minutes import WATERMARK, start_query

# A symbol without a minute for longer starts anew: its next figures are null until there are five minutes again.
# That is decided by the minutes themselves; the state goes at the same time, whenever the batches end.
IDLE = timedelta(days=7)
ROLLED = "symbol string, window_start_ts timestamp, rolling_std double"
_STATE = "starts array<bigint>, means array<double>"


def deviations(means: np.ndarray, rows: int, starts: np.ndarray | None = None, idle: int = 0) -> np.ndarray:
    """Sample deviation of each value and the `rows - 1` before it; NaN where there are fewer since the last gap.

    A gap is a step between `starts` of more than `idle`.
    """
    made = np.full(len(means), np.nan)
    if len(means) >= rows:
        made[rows - 1 :] = np.lib.stride_tricks.sliding_window_view(means, rows).std(axis=1, ddof=1)
    if starts is not None:
        for gap in np.flatnonzero(np.diff(starts) > idle):
            made[gap + 1 : gap + rows] = np.nan
    return made


def final_minutes(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Streaming minutes, each once, when it is final."""
    minutes = minute_groups(timed_trades(messages, watermark))
    return minutes.select("symbol", F.col("bucket.start").alias("window_start_ts"), *MEASURES)


def start_final_minutes(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    watermark: str = WATERMARK,
    available_now: bool = False,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append final minutes to a folder of Parquet files, each once also after failures."""
    writer = (
        final_minutes(messages, watermark)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", folder)
        .format("parquet")
    )
    return start_query(writer, messages.sparkSession, available_now, processing_time, state_partitions)


def read_final_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of the minutes that `start_final_minutes` appends."""
    fields = [field for field in BAR_SCHEMA if field.name in (*KEYS, *MEASURES)]
    return spark.readStream.schema(StructType(fields)).parquet(folder)


def rolling_updates(minutes: DataFrame, rows: int = ROLLING_ROWS, idle: timedelta = IDLE) -> DataFrame:
    """(symbol, minute, deviation) of a stream of final minutes; null until a symbol has `rows` minutes."""
    idle_ms = idle // timedelta(milliseconds=1)

    def roll(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        new = pd.concat(list(frames)).sort_values("start")
        starts, means = state.get if state.exists else ([], [])
        known = len(starts)
        starts = np.concatenate([np.array(starts, np.int64), new["start"].to_numpy(np.int64)])
        means = np.concatenate([np.array(means, float), new["mean"].to_numpy(float)])
        made = deviations(means, rows, starts, idle_ms * 1000)[known:]
        kept = slice(max(0, len(starts) - rows + 1), None)
        state.update((starts[kept].tolist(), means[kept].tolist()))
        newest_ms = int(starts[-1]) // 1000
        state.setTimeoutTimestamp(max(newest_ms, state.getCurrentWatermarkMs()) + idle_ms)
        yield pd.DataFrame(
            {
                "symbol": key[0],
                "window_start_ts": pd.to_datetime(starts[known:], unit="us", utc=True),
                "rolling_std": pd.Series(made, dtype=object).where(~np.isnan(made), None),
            }
        )

    # Minutes arrive in the order in which they closed, so none is later than the newest of an earlier batch.
    timed = minutes.withWatermark("window_start_ts", "0 seconds").select(
        "symbol",
        "window_start_ts",
        F.unix_micros("window_start_ts").alias("start"),
        F.col("price_avg").cast("double").alias("mean"),
    )
    return timed.groupBy("symbol").applyInPandasWithState(
        roll, ROLLED, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def start_rolling_stream(
    minutes: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    rows: int = ROLLING_ROWS,
    idle: timedelta = IDLE,
    available_now: bool = False,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Hand the figures of each batch to `write` with the batch's number, which a replay repeats."""
    writer = (
        rolling_updates(minutes, rows, idle)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return start_query(writer, minutes.sparkSession, available_now, processing_time, state_partitions)
