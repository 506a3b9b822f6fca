from tapemill.sources.bars import read_bars_jdbc
from tapemill.sources.messages import read_messages, read_trade_stream, read_trade_topic

__all__ = ["read_bars_jdbc", "read_messages", "read_trade_stream", "read_trade_topic"]
