"""Declared schemas of every relation, and the fixed values results depend on."""

from pyspark.sql import types as T

# Exchange message: event time in ms (T, else E), symbol, price and quantity as text, maker flag.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("E", T.LongType()),
        T.StructField("T", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("p", T.StringType()),
        T.StructField("q", T.StringType()),
        # Any JSON value: what counts is whether it is true in the exchange's sense.
        T.StructField("m", T.VariantType()),
    ]
)

# The exchange's trade id in a message, whatever its JSON type; it is unique within a symbol.
RAW_ID = T.StructField("t", T.StringType())

# Normalised trade as it travels on the topic.
TRADE_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("qty", T.DoubleType()),
        T.StructField("side", T.StringType()),
    ]
)

# A trade that can be told from a second copy of itself.
IDENTIFIED_SCHEMA = T.StructType([*TRADE_SCHEMA.fields, T.StructField("trade_id", T.StringType())])

# Record of the topic: bytes.
TOPIC_SCHEMA = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])

# Precision of the aggregate tables.
PRICE_SCALE = 8
VOLUME_SCALE = 10
PRICE_TYPE = T.DecimalType(18, PRICE_SCALE)
VOLUME_TYPE = T.DecimalType(38, VOLUME_SCALE)

# Smallest magnitude that no longer fits PRICE_TYPE.
PRICE_LIMIT = 1e10

KEYS = ["symbol", "window_start_ts"]
MEASURES = ["trade_cnt", "volume_sum", "price_avg", "price_min", "price_max"]

# Minute table and hour table share one schema; (symbol, window_start_ts) is the key.
BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("window_start_ts", T.TimestampType(), False),
        T.StructField("trade_cnt", T.LongType(), False),
        T.StructField("volume_sum", VOLUME_TYPE, False),
        T.StructField("price_avg", PRICE_TYPE, False),
        T.StructField("price_min", PRICE_TYPE, False),
        T.StructField("price_max", PRICE_TYPE, False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)
