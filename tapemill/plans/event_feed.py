"""Trades and exchange messages derived from the `events` table, and the fixed clock of the checks.

The table spans 30 days with about one event per minute and type; time is compressed 120-fold into six hours
so that minutes hold many trades. Every event becomes a trade.
"""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORIGIN_MS = 1704067200000
COMPRESSION = 120

# Minute-aligned, so the recent panel sees eleven minutes and its limit of ten matters.
CLOCK = datetime(2024, 1, 1, 5, 59, tzinfo=timezone.utc)

# Every FAULT_CYCLE events one message of each kind is damaged, by event_id modulo the cycle.
FAULT_CYCLE = 40
FAULTS = {
    "not json": 1,
    "zero trade time": 3,
    "no trade time": 5,
    "price not a number": 7,
    "no quantity": 9,
    "no maker flag": 11,
    "no symbol": 13,
    "no time at all": 15,
    "nanoseconds": 17,
    "microseconds": 19,
    "time below range": 21,
    "maker flag 1": 22,
    "maker flag 0": 24,
    "maker flag text": 26,
    "maker flag empty text": 28,
    "two messages": 31,
    "forged wrapper": 33,
}
# Values of the time and the maker flag in the messages damaged so.
FAULT_TIMES = {
    "nanoseconds": "1700000000000000000",
    "microseconds": "1700000000000000",
    "time below range": "-99999999999999999",
}
FAULT_FLAGS = {"maker flag 1": "1", "maker flag 0": "0", "maker flag text": '"true"', "maker flag empty text": '""'}


VENUES = 500

# The stream gets the trades in two phases, before this time and from it on, and then late ones of both. The time lies
# within a minute, whose window is then emitted twice.
PHASE_END_MS = ORIGIN_MS + 7_230_000
LATE_CYCLE, LATE_SLOT = 10, 3
# Every seventh trade is published twice within its phase.
TWICE_CYCLE, TWICE_SLOT = 7, 2

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def event_trades(events: DataFrame) -> DataFrame:
    """One trade per event: the type as symbol, the value as price, the number in props as quantity."""
    timed = events.withColumn("event_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return timed.select(
        F.expr(f"{ORIGIN_MS} + (event_ms - {ORIGIN_MS}) DIV {COMPRESSION}").alias("ts"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("qty"),
        F.when(F.col("event_id") % 2 == 0, "sell").otherwise("buy").alias("side"),
        "event_id",
    )


def event_messages(events: DataFrame) -> DataFrame:
    """The exchange message of every event, some of them damaged in the ways listed in FAULTS."""
    slot = F.col("event_id") % FAULT_CYCLE

    def unless(*faults: str) -> Column:
        return ~slot.isin([FAULTS[fault] for fault in faults])

    def fault(name: str) -> Column:
        return slot == FAULTS[name]

    time, flag = F.col("ts").cast("string"), F.when(F.col("side") == "sell", "true").otherwise("false")
    for name, value in FAULT_TIMES.items():
        time = F.when(fault(name), value).otherwise(time)
    for name, value in FAULT_FLAGS.items():
        flag = F.when(fault(name), value).otherwise(flag)
    fields = {
        "E": F.when(unless("no time at all"), time),
        "T": F.when(fault("zero trade time"), "0").when(unless("no trade time", "no time at all"), time),
        "s": F.when(unless("no symbol"), _quoted(F.col("symbol"))),
        "p": _quoted(F.when(fault("price not a number"), "n/a").otherwise(F.col("price").cast("string"))),
        "q": F.when(unless("no quantity"), _quoted(F.col("qty").cast("string"))),
        "m": F.when(unless("no maker flag"), flag),
    }
    # What is null is left out.
    members = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]
    message = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    damaged = (
        F.when(fault("not json"), F.concat(F.lit("trade "), F.col("event_id").cast("string")))
        .when(fault("two messages"), F.concat(message, F.lit(","), message))
        .when(fault("forged wrapper"), F.concat(message, F.lit(',"message":'), message))
        .otherwise(message)
    )
    return event_trades(events).select(damaged.alias("value"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def event_records(events: DataFrame) -> DataFrame:
    """Topic records of all trades as text, some of them damaged: cut off, without a price, or out of time."""
    slot = F.col("event_id") % FAULT_CYCLE
    time = F.col("ts")
    for name, value in FAULT_TIMES.items():
        time = F.when(slot == FAULTS[name], int(value)).otherwise(time)
    price = F.when(slot != FAULTS["price not a number"], F.col("price"))
    record = F.to_json(F.struct(time.alias("ts"), "symbol", price.alias("price"), "qty", "side"))
    cut = F.when(slot == FAULTS["not json"], F.substring(record, 1, 5)).otherwise(record)
    return event_trades(events).select(cut.alias("value"))


def fine_trades(events: DataFrame) -> DataFrame:
    """Trades whose quantities run from 1e-10 to beyond 1e18, and whose prices are ties at the ninth decimal."""
    number = F.col("event_id")
    qty = F.format_string("%d.%03de%d", number % 9 + 1, number % 997, number % 29 - 10)
    price = F.format_string("%d.%08d5", number % 100, number * 7919 % 100_000_000)
    return event_trades(events).withColumns({"qty": qty.cast("double"), "price": price.cast("double")})


def read_event_trades(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    """Trades of the whole table, or those at `since` and later, as a filter the scan can use.

    A trade's time is derived from the stored one, so Spark cannot carry a range over to the scan itself.
    """
    events = read_events(spark, sf_dir)
    if since is not None:
        origin = datetime.fromtimestamp(ORIGIN_MS / 1000, timezone.utc)
        stored = origin + (since - origin) * COMPRESSION
        events = events.where(F.col("ts") >= F.lit(f"{stored:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz"))
    return event_trades(events)


def thin_trades(events: DataFrame) -> DataFrame:
    """The trades dealt among VENUES symbols of each type, whose feeds have gaps."""
    venue = (F.col("event_id") % VENUES).cast("string")
    return event_trades(events).withColumn("symbol", F.concat_ws("-", "symbol", venue))


def in_phases(trades: DataFrame) -> list[DataFrame]:
    """All trades in two phases of time, cut within a minute."""
    first = F.col("ts") < PHASE_END_MS
    return [trades.where(first), trades.where(~first)]


def with_late(trades: DataFrame) -> list[DataFrame]:
    """All trades: two phases of time, then every tenth of both, late."""
    late = F.col("event_id") % LATE_CYCLE == LATE_SLOT
    return [*in_phases(trades.where(~late)), trades.where(late)]


def with_retries(trades: DataFrame) -> list[DataFrame]:
    """All trades with ids, in two phases; some occur twice in their phase, and the second repeats the first."""
    named = trades.withColumn("trade_id", F.col("event_id").cast("string"))
    first, second = in_phases(named)
    twice = F.col("event_id") % TWICE_CYCLE == TWICE_SLOT
    return [first.union(first.where(twice)), second.union(second.where(twice)).union(first)]
