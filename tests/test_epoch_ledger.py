"""Batches merged once into a database: the statements, tried in the engine the oracles run on."""

import duckdb
import pytest
from helpers import NOON, bars
from pyspark.sql.readwriter import DataFrameWriter

from tapemill.sinks import jdbc
from tapemill.sinks.jdbc import create_statement, ledger_statement, merge_once, staging_name, upsert_epoch_jdbc

ADD = "INSERT INTO {} (symbol, window_start_ts, trade_cnt, volume_sum, price_avg, price_min, price_max) VALUES "
ROW = "('{}', TIMESTAMPTZ '2024-03-05 12:00:00+00', {}, 1, 1, 1, 1)"


class Connection:
    """A DB-API connection: a transaction is open from the first statement to its commit."""

    def __init__(self, database, log=None):
        self.database, self.open, self.log = database, False, [] if log is None else log

    def cursor(self):
        return self

    def execute(self, statement):
        if not self.open:
            self.database.execute("BEGIN")
            self.open = True
        self.result = self.database.execute(statement)

    def fetchone(self):
        return self.result.fetchone()

    def commit(self):
        self.database.execute("COMMIT")
        self.open = False

    def rollback(self):
        self.database.execute("ROLLBACK")
        self.open = False

    def close(self):
        if self.open:
            self.rollback()
        self.log.append("closed")


@pytest.fixture
def database():
    made = duckdb.connect()
    for name in ("target", staging_name("staging", 0), staging_name("staging", 1)):
        made.execute(create_statement(name))
    made.execute(ledger_statement("ledger"))
    return made


def stage(database, epoch, rows):
    own = staging_name("staging", epoch)
    database.execute(f"DELETE FROM {own}")
    database.execute(ADD.format(own) + ", ".join(ROW.format(*row) for row in rows))
    return own


def merge(database, epoch, rows, job="minutes"):
    own = stage(database, epoch, rows)
    connection = Connection(database)
    try:
        return merge_once(connection, "target", own, "ledger", job, epoch)
    finally:
        connection.close()


def target(database):
    return dict(database.execute("SELECT symbol, trade_cnt FROM target ORDER BY symbol").fetchall())


def test_a_batch_is_merged_once(database):
    assert merge(database, 0, [("A", 1), ("B", 1)])
    assert merge(database, 1, [("A", 2)])
    # Replays, of the last batch and of one before it, whose rows have been replaced since.
    assert not merge(database, 1, [("A", 2)])
    assert not merge(database, 0, [("A", 1), ("B", 1)])
    assert target(database) == {"A": 2, "B": 1}
    assert database.execute("SELECT epoch FROM ledger ORDER BY 1").fetchall() == [(0,), (1,)]


def test_a_failed_merge_leaves_no_entry(database, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(jdbc, "merge_statement", lambda *_: "INSERT INTO nowhere VALUES (1)")
        with pytest.raises(duckdb.CatalogException):
            merge(database, 0, [("A", 1)])
    assert target(database) == {}
    assert database.execute("SELECT COUNT(*) FROM ledger").fetchone() == (0,)
    assert merge(database, 0, [("A", 1)])


def test_a_crash_before_the_commit_changes_nothing(database, monkeypatch):
    def crash(self):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Connection, "commit", crash)
        with pytest.raises(OSError, match="lost"):
            merge(database, 0, [("A", 1)])
    assert target(database) == {}
    assert merge(database, 0, [("A", 1)])
    assert target(database) == {"A": 1}


def test_jobs_have_their_own_numbers(database):
    assert merge(database, 5, [("A", 1)], "minutes")
    assert merge(database, 2, [("B", 1)], "o'hours")
    assert not merge(database, 2, [("B", 9)], "o'hours")
    assert target(database) == {"A": 1, "B": 1}


def test_one_entry_for_each_batch(database):
    database.execute(jdbc.entry_statement("ledger", "minutes", 3))
    with pytest.raises(duckdb.ConstraintException):
        database.execute(jdbc.entry_statement("ledger", "minutes", 3))


def test_a_known_batch_is_not_staged(spark, database, monkeypatch):
    """The write half is a stand-in, as no database server can be reached here."""
    log = []

    def save(writer):
        log.append("staged")
        stage(database, 4, [("A", 7)])

    monkeypatch.setattr(DataFrameWriter, "save", save)
    arguments = (4, "target", "staging", "ledger", "minutes", lambda: Connection(database, log))
    batch = bars(spark, [("A", NOON, 7, 1, 1)])
    assert upsert_epoch_jdbc(batch, *arguments, url="jdbc:x")
    assert not upsert_epoch_jdbc(batch, *arguments, url="jdbc:x")
    assert log == ["staged", "closed", "closed"]
    assert target(database) == {"A": 7}
