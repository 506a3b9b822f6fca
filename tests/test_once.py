"""Trades that retries publish again."""

import json
import os

import pytest
from helpers import NOON, at, ms
from pyspark.sql import functions as F

from tapemill.operators.trades import encode_trades, normalize_trades, parse_trades
from tapemill.schemas import RAW_SCHEMA
from tapemill.sinks import BarTable
from tapemill.sources import read_trade_stream
from tapemill.streaming import once_only, start_minute_stream


def line(time, symbol, price, trade_id=None):
    fields = {"ts": ms(time), "symbol": symbol, "price": price, "qty": 1, "side": "buy", "trade_id": trade_id}
    return json.dumps({name: value for name, value in fields.items() if value is not None})


class Feed:
    """A landing folder, one micro-batch per file, and the minute table behind it."""

    def __init__(self, spark, folder, once=True):
        self.spark, self.folder, self.once = spark, folder, once
        self.landing = folder / "landing"
        self.landing.mkdir()
        self.table = BarTable(spark, str(folder / "table"))
        self.files = 0

    def land(self, *lines):
        path = self.landing / f"{self.files:04d}.txt"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def run(self):
        messages = read_trade_stream(self.spark, "text", str(self.landing), maxFilesPerTrigger="1")
        query = start_minute_stream(
            messages,
            lambda batch: self.table.upsert(batch, NOON, keyed=True),
            str(self.folder / "checkpoint"),
            available_now=True,
            once=self.once,
        )
        query.awaitTermination()
        return query

    def counts(self):
        out = self.table.read().select("symbol", F.date_format("window_start_ts", "HH:mm").alias("m"), "trade_cnt")
        return {(row.symbol, row.m): row.trade_cnt for row in out.collect()}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_a_batch_published_again_changes_nothing(feed):
    first = [line(NOON, "A", 1, "1"), line(at(seconds=5), "A", 3, "2"), line(at(seconds=70), "B", 1, "1")]
    feed.land(*first)
    feed.run()
    before = feed.counts()
    feed.land(*first)
    feed.land(*first, line(at(seconds=10), "A", 2, "3"))
    feed.run()
    assert before == {("A", "12:00"): 2, ("B", "12:01"): 1}
    assert feed.counts() == {("A", "12:00"): 3, ("B", "12:01"): 1}


def test_without_ids_each_copy_counts(spark, tmp_path, feed):
    """What `once` is for, and that trades without an id are not merged by it."""
    feed.land(line(NOON, "A", 1), line(NOON, "A", 1))
    feed.run()
    assert feed.counts() == {("A", "12:00"): 2}
    (tmp_path / "plain").mkdir()
    plain = Feed(spark, tmp_path / "plain", once=False)
    plain.land(line(NOON, "A", 1, "1"), line(NOON, "A", 1, "1"))
    plain.run()
    assert plain.counts() == {("A", "12:00"): 2}


def test_late_trades_of_open_windows_are_kept(feed):
    """Watermark 12:08:10: 12:08:01 is older than it, but its window is open, so trade and copy are told apart."""
    feed.land(line(at(minutes=10, seconds=10), "A", 1, "1"))
    feed.land(line(at(minutes=10, seconds=20), "A", 1, "2"))
    late = line(at(minutes=8, seconds=1), "A", 1, "3")
    feed.land(late, late, line(at(minutes=7, seconds=59), "A", 1, "4"))
    feed.land(late)
    feed.run()
    assert feed.counts() == {("A", "12:08"): 1, ("A", "12:10"): 2}


def test_ids_are_forgotten_with_their_window(feed):
    for minute in range(0, 30, 3):
        feed.land(line(at(minutes=minute), "A", 1, str(minute)))
    progress = feed.run().recentProgress
    kept = [p["stateOperators"][-1]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(kept) <= 4
    assert len(feed.counts()) == 10


def test_ids_of_messages(spark):
    fields = {"E": 900, "T": 1000, "s": "BTC", "p": "10.5", "q": "2"}
    messages = spark.createDataFrame(
        [(json.dumps(fields | extra), part, offset) for extra, part, offset in
         [({"t": 77}, 0, 1), ({"t": "x-1"}, 0, 2), ({}, 3, 4), ({"t": None}, 3, 5), ({"t": ""}, 3, 6)]],
        "value string, partition int, offset long",
    )
    found = {row["trade_id"] for row in normalize_trades(messages, identified=True).collect()}
    assert found == {"77", "x-1", "@3-4", "@3-5", "@3-6"}
    alone = normalize_trades(messages.select("value"), identified=True)
    assert {row["trade_id"] for row in alone.collect()} == {"77", "x-1", None}
    assert "trade_id" not in normalize_trades(messages).columns
    assert "t" not in RAW_SCHEMA.fieldNames()


def test_ids_travel_with_the_trade(spark):
    messages = spark.createDataFrame(
        [(json.dumps({"E": 900, "T": 1000, "s": "BTC", "p": "10.5", "q": "2", "t": 5}),)], "value string"
    )
    record = encode_trades(normalize_trades(messages, identified=True))
    assert json.loads(record.first()["value"])["trade_id"] == "5"
    assert parse_trades(record, identified=True).first()["trade_id"] == "5"
    # A reader that knows of no ids reads the same trade.
    assert parse_trades(record).first()["symbol"] == "BTC"


def test_batch_of_copies(spark):
    rows = [(NOON, "A", "1"), (NOON, "A", "1"), (NOON, "B", "1"), (at(minutes=5), "A", "1"), (NOON, "A", None), (NOON, "A", None)]
    trades = spark.createDataFrame(rows, "event_time timestamp, symbol string, trade_id string")
    assert once_only(trades).count() == 5
