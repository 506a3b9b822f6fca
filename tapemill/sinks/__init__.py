from tapemill.sinks.jdbc import create_statement, ledger_statement, merge_statement, upsert_epoch_jdbc, upsert_jdbc
from tapemill.sinks.merge import merge_into
from tapemill.sinks.snapshot import restored, snapshot_tables
from tapemill.sinks.table import BarTable
from tapemill.sinks.topic import publish_trades, write_trade_topic

__all__ = [
    "BarTable",
    "create_statement",
    "ledger_statement",
    "merge_into",
    "merge_statement",
    "publish_trades",
    "restored",
    "snapshot_tables",
    "upsert_epoch_jdbc",
    "upsert_jdbc",
    "write_trade_topic",
]
