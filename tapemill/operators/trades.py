"""From exchange messages to trades: normalise, reject, encode for the topic, parse back."""

import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType

from tapemill.functions import event_time, usable_price, usable_qty, usable_time
from tapemill.schemas import IDENTIFIED_SCHEMA, RAW_ID, RAW_SCHEMA, TRADE_SCHEMA, VOLUME_TYPE

TRADE_COLUMNS = TRADE_SCHEMA.fieldNames()
# Where a topic holds a message; stays the same however often the message is read.
_POSITION = ("partition", "offset")


def _number(text: Column) -> Column:
    # A text such as "1.5d" casts to double; the decimal cast does not let it (or NaN) through.
    return F.when(text.try_cast(VOLUME_TYPE).isNotNull(), text.try_cast("double"))


def _once(parsed: Column, *steps: Callable[[Column], Column]) -> Column:
    """What the steps make of a parsed JSON text, as columns; the text is parsed once per record.

    A filter on a field of a plain `from_json` column is pushed below it, and the parse then repeats for
    every mention of a field in the filter. Nothing is pushed below a generator, and within one the steps
    get each value as a lambda's variable.
    """
    made = F.array(parsed)
    for step in steps:
        made = F.transform(made, step)
    return F.inline(made)


def _strict_json(
    text: Column, schema: StructType, renamed: StructType | None = None
) -> tuple[Column, Callable[[Column], Column]]:
    """Like from_json, but text after the object or single quotes make the record unreadable too.

    from_json stops at the end of the first value. Here that is an array of the message and a mark, which no
    message can hold, as it is drawn anew for each plan. Returns the array and the step that takes the message.
    `renamed` has other names for the same fields, for messages whose names differ by case alone.
    """
    mark = f"end-{uuid.uuid4().hex}"
    end = StructField(mark, BooleanType())
    element = StructType([*schema.fields, end])
    wrapped = F.concat(F.lit("["), text, F.lit(f',{{"{mark}":true}}]'))
    array = F.from_json(wrapped, ArrayType(element), {"allowSingleQuotes": "false"})
    if renamed is not None:
        array, schema = array.cast(ArrayType(StructType([*renamed.fields, end]))), renamed

    def message(values: Column) -> Column:
        whole = (F.size(values) == 2) & values[0][mark].isNull() & values[1][mark]
        return F.when(whole, F.struct(*[values[0][name].alias(name) for name in schema.fieldNames()]))

    return array, message


def _is_true(flag: Column) -> Column:
    """False for a JSON value that is missing, null, false, a zero, or an empty text, list or object."""
    text = F.to_json(flag)
    zero = F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return F.coalesce(~(text.isin("null", "false", '""', "[]", "{}") | zero), F.lit(False))


def _all_null(columns: Iterable[Column]) -> Column:
    return reduce(and_, [column.isNull() for column in columns])


def _usable() -> Column:
    price, qty = usable_price(F.col("price")), usable_qty(F.col("qty"))
    return usable_time(F.col("ts")) & F.col("symbol").isNotNull() & price & qty


def _reject_reason() -> Column:
    """NULL for a usable trade, else the first thing wrong with it."""
    return (
        F.when(_all_null(map(F.col, ("ts", "symbol", "price", "qty"))), "unreadable message")
        .when(F.col("ts").isNull(), "no event time")
        .when(~usable_time(F.col("ts")), "bad event time")
        .when(~usable_price(F.col("price")), "bad price")
        .when(~usable_qty(F.col("qty")), "bad quantity")
        .when(F.col("symbol").isNull(), "no symbol")
    )


def trade_columns(trades: DataFrame) -> list[str]:
    """Columns of a trade's record: those of every trade, and its id if the frame has one."""
    return [*TRADE_COLUMNS, *(name for name in ("trade_id",) if name in trades.columns)]


def _from_messages(messages: DataFrame, symbol: str | None, identified: bool = False) -> DataFrame:
    message = messages.select(F.col("value").cast("string").alias("value"))
    if identified:
        known = [F.col(name).cast("string") for name in _POSITION if name in messages.columns]
        position = F.concat(F.lit("@"), F.concat_ws("-", *known)) if len(known) == len(_POSITION) else F.lit(None)
        message = messages.select(F.col("value").cast("string").alias("value"), position.cast("string").alias("position"))
    parsed, pick = _strict_json(F.col("value"), RAW_SCHEMA)
    if identified:
        named = StructType([*RAW_SCHEMA.fields, StructField("trade_id", RAW_ID.dataType)])
        parsed, pick = _strict_json(F.col("value"), StructType([*RAW_SCHEMA.fields, RAW_ID]), named)

    def trade(raw: Column) -> Column:
        constant = F.when(~_all_null(raw[name] for name in RAW_SCHEMA.fieldNames()), F.lit(symbol))
        return F.struct(
            # T = 0 counts as missing, like T itself being absent.
            F.coalesce(F.nullif(raw["T"], F.lit(0)), raw["E"]).alias("ts"),
            (raw["s"] if symbol is None else constant).alias("symbol"),
            _number(raw["p"]).alias("price"),
            _number(raw["q"]).alias("qty"),
            F.when(_is_true(raw["m"]), "sell").otherwise("buy").alias("side"),
            *([raw["trade_id"].alias("trade_id")] if identified else []),
        )

    decoded = message.select("*", _once(parsed, pick, trade))
    if not identified:
        return decoded
    return decoded.withColumn("trade_id", F.coalesce(F.nullif("trade_id", F.lit("")), "position")).drop("position")


def normalize_trades(messages: DataFrame, symbol: str | None = None, identified: bool = False) -> DataFrame:
    """Trades of exchange messages; `symbol` overrides the message's own.

    `identified` adds `trade_id`: the exchange's id, else the message's place in its topic, else null. It is the
    same each time a message is read, so a trade that a retry publishes again can be told from a new one.
    """
    trades = _from_messages(messages, symbol, identified)
    return trades.where(_usable()).select(*trade_columns(trades))


def classify_messages(messages: DataFrame, symbol: str | None = None, identified: bool = False) -> DataFrame:
    """Every message with its trade columns and, where it is unusable, a `reason`.

    Writing both the trades and the rejects of one feed from this frame costs a single parse.
    """
    return _from_messages(messages, symbol, identified).withColumn("reason", _reject_reason())


def rejected_trades(messages: DataFrame, symbol: str | None = None) -> DataFrame:
    return _rejects(_from_messages(messages, symbol))


def _rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(~_usable()).select("value", _reject_reason().alias("reason"))


def encode_trades(trades: DataFrame) -> DataFrame:
    """Topic record: the symbol as key, the trade (with its id, if it has one) as JSON, both UTF-8 bytes."""
    return trades.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(F.struct(*trade_columns(trades))).cast("binary").alias("value"),
    )


def _decoded(messages: DataFrame, identified: bool = False) -> DataFrame:
    message = messages.select(F.col("value").cast("string").alias("value"))
    return message.select("value", _once(F.from_json("value", IDENTIFIED_SCHEMA if identified else TRADE_SCHEMA)))


def decode_records(messages: DataFrame) -> DataFrame:
    """Every topic record with its trade columns, and whether they are a usable trade."""
    return _decoded(messages).withColumn("usable", _usable())


def parse_trades(messages: DataFrame, identified: bool = False) -> DataFrame:
    """Trades of a topic with their event time, and with their id if `identified`; for a stream and for a batch.

    Records the aggregate tables could not hold (no time, symbol, price or quantity) are left out here and
    listed by `unparsed_trades`: one of them would otherwise fail the write of its whole batch.
    """
    decoded = _decoded(messages, identified)
    return with_event_time(decoded.where(_usable()).select(*trade_columns(decoded)))


def unparsed_trades(messages: DataFrame) -> DataFrame:
    return _rejects(_decoded(messages))


def with_event_time(trades: DataFrame) -> DataFrame:
    return trades.withColumn("event_time", event_time(F.col("ts")))
