"""The registered queries, each over the whole `events` table of a data folder."""

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill.functions import display_time, event_time, parse_time
from tapemill.operators import panels
from tapemill.operators.bars import hour_bars, minute_bars, rollup_1h
from tapemill.operators.contract import conform_bars, contract_violations
from tapemill.operators.moments import hour_moments, merged_moments, read_moments, volatility, write_moments
from tapemill.operators.outages import outages, symbol_freshness
from tapemill.operators.quality import freshness_report, ingest_status
from tapemill.operators.trades import (
    encode_trades,
    normalize_trades,
    parse_trades,
    rejected_trades,
    unparsed_trades,
    with_event_time,
)
from tapemill.plans.event_feed import (
    CLOCK,
    event_messages,
    event_records,
    fine_trades,
    in_phases,
    read_event_trades,
    read_events,
    thin_trades,
    with_late,
    with_retries,
)
from tapemill.plans.hourly import run_hourly
from tapemill.schemas import KEYS, MEASURES, TOPIC_SCHEMA
from tapemill.session import configure, work_dir
from tapemill.sinks import BarTable, snapshot_tables
from tapemill.sources import read_trade_stream
from tapemill.streaming import (
    heartbeat,
    kept_records,
    late_records,
    read_final_minutes,
    start_final_minutes,
    start_hour_stream,
    start_late_route,
    start_minute_stream,
    start_rolling_stream,
)
from tapemill.streaming.rolling import ROLLED

Query = Callable[[SparkSession, str], DataFrame]

# Symbol of the single-symbol panels.
SYMBOL = "purchase"
DIGITS = 6
HOUR = timedelta(hours=1)


def _comparable(frame: DataFrame) -> DataFrame:
    """Zone-less times, and decimals as text, so that every digit is compared."""
    columns = []
    for field in frame.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.BinaryType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return frame.select(columns)


def _rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, DIGITS) for name in names})


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(read_events(spark, sf_dir))


def _trades(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    return with_event_time(read_event_trades(spark, sf_dir, since))


def _minutes(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    """All minutes, or those the operator on top will keep: a window from `since` on holds no older trade."""
    return minute_bars(_trades(spark, sf_dir, since))


def _table_rows(table: BarTable) -> DataFrame:
    return table.read().select(*KEYS, *MEASURES)


def _streamed(spark: SparkSession, purpose: str, phases: list[DataFrame], once: bool = False) -> DataFrame:
    """The continuous job over a folder that gets one phase of JSON records after the other; the minute table.

    Each phase is at least one micro-batch of a query that is started again on its checkpoint.
    """
    root = work_dir(spark, purpose)
    table = BarTable(spark, f"{root}/trade_agg_1m")
    for phase in phases:
        encode_trades(phase).write.mode("append").parquet(f"{root}/topic")
        query = start_minute_stream(
            read_trade_stream(spark, "parquet", f"{root}/topic", TOPIC_SCHEMA),
            lambda batch: table.upsert(batch, CLOCK, keyed=True),
            f"{root}/checkpoint",
            available_now=True,
            state_partitions=spark.sparkContext.defaultParallelism,
            once=once,
        )
        query.awaitTermination()
    return _table_rows(table)


def _agg_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, "agg_1m_stream", in_phases(read_event_trades(spark, sf_dir)))


def _agg_1m_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes of a topic on which retries published many trades again."""
    return _streamed(spark, "agg_1m_once", with_retries(read_event_trades(spark, sf_dir)), once=True)


def _late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, "late_data", with_late(read_event_trades(spark, sf_dir)))


def _landed(spark: SparkSession, sf_dir: str, root: str) -> Iterator[DataFrame]:
    """The topic as a stream, after each phase of trades has landed and at last a heartbeat that closes all windows."""
    closing = heartbeat(F.lit(int((CLOCK + HOUR).timestamp() * 1000)))
    end = spark.range(1).select(F.lit(None).cast("binary").alias("key"), closing.alias("value"))
    for records in (*map(encode_trades, in_phases(read_event_trades(spark, sf_dir))), end):
        records.write.mode("append").parquet(f"{root}/topic")
        yield read_trade_stream(spark, "parquet", f"{root}/topic", TOPIC_SCHEMA)


def _rollup_1h_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from trades in one query of chained windows, started again on its checkpoint after each phase."""
    root = work_dir(spark, "rollup_1h_stream")
    table = BarTable(spark, f"{root}/trade_agg_1h", "day")
    for topic in _landed(spark, sf_dir, root):
        start_hour_stream(
            topic,
            lambda batch: table.upsert(batch, CLOCK, keyed=True),
            f"{root}/checkpoint",
            available_now=True,
            state_partitions=spark.sparkContext.defaultParallelism,
        ).awaitTermination()
    return _table_rows(table)


def _rolling_std_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling deviation from final minutes and keyed state; both queries start again after each phase."""
    root = work_dir(spark, "rolling_std_stream")
    width = spark.sparkContext.defaultParallelism
    for topic in _landed(spark, sf_dir, root):
        start_final_minutes(
            topic, f"{root}/minutes", f"{root}/checkpoint-minutes", available_now=True, state_partitions=width
        ).awaitTermination()
        start_rolling_stream(
            read_final_minutes(spark, f"{root}/minutes"),
            lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{root}/rolled/epoch={epoch}"),
            f"{root}/checkpoint",
            available_now=True,
            state_partitions=width,
        ).awaitTermination()
    return spark.read.schema(ROLLED).parquet(f"{root}/rolled/epoch=*")


def _late_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per minute, the trades that count and those that came too late to; each trade is in one of the two."""
    root = work_dir(spark, "late_trades")
    table = BarTable(spark, f"{root}/trade_agg_1m")
    for phase in with_late(read_event_trades(spark, sf_dir)):
        encode_trades(phase).write.mode("append").parquet(f"{root}/topic")
        topic = read_trade_stream(spark, "parquet", f"{root}/topic", TOPIC_SCHEMA)
        start_late_route(topic, f"{root}/routes", f"{root}/checkpoint-routes", available_now=True).awaitTermination()
        start_minute_stream(
            kept_records(spark, f"{root}/routes"),
            lambda batch: table.upsert(batch, CLOCK, keyed=True),
            f"{root}/checkpoint",
            available_now=True,
            state_partitions=spark.sparkContext.defaultParallelism,
        ).awaitTermination()
    late = late_records(spark, f"{root}/routes").select(
        F.col("key").cast("string").alias("symbol"),
        F.date_trunc("minute", "event_time").alias("window_start_ts"),
        F.lit(0).cast("bigint").alias("trade_cnt"),
        F.lit(1).alias("late"),
    )
    kept = table.read().select(*KEYS, "trade_cnt", F.lit(0).alias("late"))
    return kept.union(late).groupBy(*KEYS).agg(
        F.sum("trade_cnt").alias("trade_cnt"), F.sum("late").cast("bigint").alias("late_cnt")
    )


def _stored(frame: DataFrame, folder: str) -> DataFrame:
    """The frame written out and read back, so that what follows does not scan the trades again."""
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def _upsert_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minutes, then twice the minutes recomputed from sells alone, which replace theirs."""
    root = work_dir(spark, "upsert_1m")
    table = BarTable(spark, f"{root}/trade_agg_1m", partition_by="hour")
    table.upsert(_minutes(spark, sf_dir), CLOCK)
    sells = _stored(minute_bars(_trades(spark, sf_dir).where("side = 'sell'")), f"{root}/sells")
    table.upsert(sells, CLOCK)
    table.upsert(sells, CLOCK)
    return _table_rows(table)


def _upsert_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two consecutive hourly runs; the hour they share is replaced, not added."""
    root = work_dir(spark, "upsert_1h")
    minutes = _stored(_minutes(spark, sf_dir), f"{root}/trade_agg_1m")
    table = BarTable(spark, f"{root}/trade_agg_1h")
    for now in (CLOCK - HOUR, CLOCK):
        table.upsert(rollup_1h(minutes, now), now)
    return _table_rows(table)


def _run_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of gate, rollup and snapshot at two consecutive hours; the hour table."""
    root = work_dir(spark, "run_hourly")
    minutes, hours = BarTable(spark, f"{root}/trade_agg_1m"), BarTable(spark, f"{root}/trade_agg_1h")
    minutes.upsert(_minutes(spark, sf_dir), CLOCK)
    for now in (CLOCK - HOUR, CLOCK):
        run_hourly(minutes, hours, f"{root}/backups", now)
    return _table_rows(hours)


def _contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with every seventh bar twice, and a copy without its symbol of every eleventh."""
    bars = conform_bars(_minutes(spark, sf_dir), CLOCK)
    minute = F.minute("window_start_ts")
    unnamed = bars.where(minute % 11 == 0).withColumn("symbol", F.lit(None).cast("string"))
    return contract_violations(bars.unionByName(bars.where(minute % 7 == 0)).unionByName(unnamed))


def _snapshot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "snapshot")
    minutes, hours = BarTable(spark, f"{root}/trade_agg_1m"), BarTable(spark, f"{root}/trade_agg_1h", "day")
    minutes.upsert(_minutes(spark, sf_dir), CLOCK, keyed=True)
    hours.upsert(hour_bars(minutes.read()), CLOCK, keyed=True)
    return snapshot_tables({"trade_agg_1m": minutes, "trade_agg_1h": hours}, f"{root}/backups", CLOCK)


def _thin_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute_bars(with_event_time(thin_trades(read_events(spark, sf_dir))))


def _hour_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moments, with the squares as a deviation; a mean of sixty prices of cents has no tie at its seventh place."""
    moments = hour_moments(_minutes(spark, sf_dir))
    deviation = F.round(F.sqrt(F.col("sq_dev") / F.col("minutes")), DIGITS)
    return moments.withColumns({"mean": F.round("mean", DIGITS + 1), "sq_dev": deviation}).withColumnRenamed(
        "sq_dev", "deviation"
    )


def _volatility_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volatility over all hours from their stored moments; minutes are read only to write these."""
    folder = work_dir(spark, "moments")
    write_moments(_minutes(spark, sf_dir), folder)
    return volatility(merged_moments(read_moments(spark, folder)))


def _display_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window starts as text, parsed and shown in the display zone."""
    text = F.date_format("window_start_ts", "yyyy-MM-dd HH:mm:ss")
    parsed = _minutes(spark, sf_dir).select("symbol", parse_time(text).alias("window_start_ts"))
    return parsed.withColumn("shown_ts", display_time(F.col("window_start_ts")))


def _panel(build: Callable[..., DataFrame], *rounded: str, **arguments: str) -> Query:
    """A frame over the last hour, or a shorter trailing range."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(build(_minutes(spark, sf_dir, CLOCK - HOUR), CLOCK, **arguments), *rounded)

    return query


_QUERIES: dict[str, Query] = {
    "normalize_trades": lambda spark, sf_dir: normalize_trades(_messages(spark, sf_dir)),
    "rejected_trades": lambda spark, sf_dir: rejected_trades(_messages(spark, sf_dir)),
    "encode_trades": lambda spark, sf_dir: encode_trades(read_event_trades(spark, sf_dir)),
    "parse_trade_json": lambda spark, sf_dir: parse_trades(encode_trades(read_event_trades(spark, sf_dir))),
    "event_time": lambda spark, sf_dir: read_event_trades(spark, sf_dir).select(
        "event_id", "ts", event_time(F.col("ts")).alias("event_time")
    ),
    "unparsed_trades": lambda spark, sf_dir: unparsed_trades(event_records(read_events(spark, sf_dir))),
    "agg_1m": _minutes,
    "agg_1m_fine": lambda spark, sf_dir: minute_bars(with_event_time(fine_trades(read_events(spark, sf_dir)))),
    "late_data": _late_data,
    "late_trades": _late_trades,
    "contract_violations": _contract_violations,
    "run_hourly": _run_hourly,
    "agg_1m_stream": _agg_1m_stream,
    "agg_1m_once": _agg_1m_once,
    "conform_agg": lambda spark, sf_dir: conform_bars(_minutes(spark, sf_dir), CLOCK),
    "upsert_1m": _upsert_1m,
    "rollup_1h": lambda spark, sf_dir: rollup_1h(_minutes(spark, sf_dir, CLOCK - 2 * HOUR), CLOCK),
    "rollup_1h_stream": _rollup_1h_stream,
    "rolling_std_stream": lambda spark, sf_dir: _rounded(_rolling_std_stream(spark, sf_dir), "rolling_std"),
    "rollup_1h_history": lambda spark, sf_dir: hour_bars(_minutes(spark, sf_dir)),
    "upsert_1h": _upsert_1h,
    "snapshot_manifest": _snapshot_manifest,
    "dq_recent_30m": _panel(freshness_report),
    "outages": lambda spark, sf_dir: outages(_thin_minutes(spark, sf_dir), CLOCK),
    "symbol_freshness": lambda spark, sf_dir: symbol_freshness(_thin_minutes(spark, sf_dir), CLOCK),
    "ingest_status": _panel(ingest_status),
    "panel_1h": _panel(panels.panel_1h),
    "panel_1h_symbol": _panel(panels.panel_1h, symbol=SYMBOL),
    "panel_recent": _panel(panels.panel_recent),
    "panel_recent_symbol": _panel(panels.panel_recent, symbol=SYMBOL),
    "recent_total": _panel(panels.recent_total),
    "kpis_1h": _panel(panels.kpis_1h, "avg_price"),
    "volatility_1h": _panel(panels.volatility_1h, "std_dev", "vol_rate"),
    "volatility_history": lambda spark, sf_dir: _rounded(_volatility_history(spark, sf_dir), "std_dev", "vol_rate"),
    "hour_moments": _hour_moments,
    "axis_range_1h": _panel(panels.axis_range_1h, "y_min", "y_max"),
    "rolling_std": _panel(panels.rolling_std, "rolling_std"),
    "rolling_std_history": lambda spark, sf_dir: _rounded(
        panels.rolling_std_history(_minutes(spark, sf_dir), chunk="hour"), "rolling_std"
    ),
    "minute_bars": _panel(panels.minute_counts),
    "price_series": _panel(panels.price_series),
    "volume_series": _panel(panels.volume_series),
    "display_time": _display_time,
    "kpi_text": _panel(panels.kpi_text),
}


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: _comparable(query(configure(spark), sf_dir))


def registered_queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in _QUERIES.items()}
