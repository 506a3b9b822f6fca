"""Keyed upsert into a relational table: executors fill a staging table, one statement merges it."""

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from tapemill.functions.temporal import Now
from tapemill.operators.contract import conform_bars
from tapemill.schemas import BAR_SCHEMA, KEYS

# Fixed value: rows per insert statement.
BATCH_ROWS = 500


# SQL names of the column types.
_SQL_TYPES = {"string": "TEXT", "timestamp": "TIMESTAMPTZ", "bigint": "BIGINT"}


def create_statement(table: str) -> str:
    """Table with the bar contract: typed columns, none nullable, one row per key, a default `updated_at`."""
    columns = []
    for field in BAR_SCHEMA:
        name = field.dataType.simpleString()
        default = " DEFAULT CURRENT_TIMESTAMP" if field.name == "updated_at" else ""
        columns.append(f"{field.name} {_SQL_TYPES.get(name, name.upper())} NOT NULL{default}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}, PRIMARY KEY ({', '.join(KEYS)}))"


def merge_statement(target: str, staging: str) -> str:
    """One atomic statement for a database with INSERT ... ON CONFLICT; repeatable."""
    names = BAR_SCHEMA.fieldNames()
    columns = ", ".join(names)
    replaced = ", ".join(f"{name} = EXCLUDED.{name}" for name in names if name not in KEYS)
    return (
        f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {staging} "
        f"ON CONFLICT ({', '.join(KEYS)}) DO UPDATE SET {replaced}"
    )


def ledger_statement(ledger: str) -> str:
    """Table of the batches that each job has merged."""
    columns = "job TEXT NOT NULL, epoch BIGINT NOT NULL, merged_at TIMESTAMPTZ NOT NULL DEFAULT CURRENT_TIMESTAMP"
    return f"CREATE TABLE IF NOT EXISTS {ledger} ({columns}, PRIMARY KEY (job, epoch))"


def entry_statement(ledger: str, job: str, epoch: int) -> str:
    """Enter a batch; in the merge's transaction, so both are there or neither."""
    return f"INSERT INTO {ledger} (job, epoch) VALUES ({_quoted(job)}, {int(epoch)})"


def last_statement(ledger: str, job: str) -> str:
    """The newest batch of a job that has been merged, null before the first."""
    return f"SELECT MAX(epoch) FROM {ledger} WHERE job = {_quoted(job)}"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def staging_name(staging: str, epoch: int, tables: int = 2) -> str:
    """Staging tables take turns, so a writer of an earlier batch that still runs does not fill this batch's."""
    return f"{staging}_{epoch % tables}"


def merge_once(connection: Any, target: str, staging: str, ledger: str, job: str, epoch: int) -> bool:
    """Merge a staged batch and enter it in one transaction; False if it or a later one has been entered.

    A replayed batch then changes nothing, also one that comes after a later batch has replaced its rows. Of two
    writers of one batch the ledger's key lets one commit.
    """
    cursor = connection.cursor()
    cursor.execute(last_statement(ledger, job))
    last = cursor.fetchone()[0]
    if last is not None and last >= epoch:
        return False
    try:
        cursor.execute(entry_statement(ledger, job, epoch))
        cursor.execute(merge_statement(target, staging))
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    return True


def upsert_epoch_jdbc(
    bars: DataFrame,
    epoch: int,
    target: str,
    staging: str,
    ledger: str,
    job: str,
    connect: Callable[[], Any],
    now: Now = None,
    **options: str,
) -> bool:
    """`upsert_jdbc` for the batches of a stream, each merged once; whether this one was.

    Create `target` and the tables that `staging_name` gives with `create_statement`, `ledger` with
    `ledger_statement`. A batch that the ledger has is not staged at all. `connect` opens a DB-API connection that does
    not commit by itself.
    """
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(last_statement(ledger, job))
        last = cursor.fetchone()[0]
        if last is not None and last >= epoch:
            return False
        own = staging_name(staging, epoch)
        _stage(bars, own, now, options)
        return merge_once(connection, target, own, ledger, job, epoch)
    finally:
        connection.close()


def _stage(bars: DataFrame, staging: str, now: Now, options: dict[str, str]) -> None:
    writer = conform_bars(bars, now).write.format("jdbc")
    writer.options(dbtable=staging, batchsize=str(BATCH_ROWS), truncate="true", **options).mode("overwrite").save()


def upsert_jdbc(
    bars: DataFrame,
    target: str,
    staging: str,
    connect: Callable[[], Any],
    now: Now = None,
    **options: str,
) -> None:
    """`options` go to the JDBC writer; `connect` opens a DB-API connection for the merge statement.

    Create both tables with `create_statement`: the writer then keeps the staging table's types, so window
    starts stay instants whatever zone the database session has. Key and null constraints are the tables'
    own; in the staging table they refuse a bad batch before the merge. An empty frame changes nothing.
    """
    _stage(bars, staging, now, options)
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(merge_statement(target, staging))
        connection.commit()
    finally:
        connection.close()
