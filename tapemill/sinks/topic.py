"""Keyed publish of trades."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tapemill.operators.trades import encode_trades


def publish_trades(trades: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish a batch of trades to Kafka, keyed by symbol."""
    options |= {"kafka.bootstrap.servers": servers, "topic": topic}
    encode_trades(trades).write.format("kafka").options(**options).save()


def write_trade_topic(
    trades: DataFrame, servers: str, topic: str, checkpoint: str, **options: str
) -> StreamingQuery:
    """Publish a stream of trades to Kafka, keyed by symbol."""
    options |= {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return encode_trades(trades).writeStream.format("kafka").options(**options).start()
