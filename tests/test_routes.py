"""Late trades: set aside, counted, and never lost between the two streams."""

import os

import pytest
from helpers import NOON, at, ms
from pyspark.sql import functions as F

from tapemill.jobs import main
from tapemill.sinks import BarTable
from tapemill.sources import read_trade_stream
from tapemill.streaming import kept_records, late_records, route_ledger, start_late_route, start_minute_stream


def line(time, symbol="A", trade_id=None):
    extra = f',"trade_id":"{trade_id}"' if trade_id else ""
    return f'{{"ts":{ms(time)},"symbol":"{symbol}","price":1,"qty":1,"side":"buy"{extra}}}'


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        self.landing = folder / "landing"
        self.landing.mkdir()
        self.root = str(folder / "routes")
        self.table = BarTable(spark, str(folder / "table"))

    def land(self, *lines):
        path = self.landing / f"{self.files:04d}.txt"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def route(self):
        messages = read_trade_stream(self.spark, "text", str(self.landing), maxFilesPerTrigger="1")
        start_late_route(messages, self.root, str(self.folder / "cp-route"), available_now=True).awaitTermination()

    def count(self, once=False):
        start_minute_stream(
            kept_records(self.spark, self.root),
            lambda batch: self.table.upsert(batch, NOON, keyed=True),
            str(self.folder / "cp"),
            available_now=True,
            once=once,
        ).awaitTermination()

    def counts(self):
        rows = self.table.read().select(F.date_format("window_start_ts", "HH:mm").alias("m"), "trade_cnt").collect()
        return {row.m: row.trade_cnt for row in rows}

    def ledger(self):
        rows = route_ledger(self.spark, self.root).orderBy("epoch").collect()
        return [(row.kept, row.late, row.unread) for row in rows]


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_closed_windows_are_set_aside(spark, feed):
    """The watermark is 12:08:10: 12:08:01 lies in an open window, 12:07:59 in a closed one."""
    feed.land(line(at(minutes=10, seconds=10)), "junk")
    feed.land(line(at(minutes=8, seconds=1)), line(at(minutes=7, seconds=59)), line(at(minutes=1), "B"))
    feed.route()
    feed.count()
    assert feed.counts() == {"12:08": 1, "12:10": 1}
    late = late_records(spark, feed.root).orderBy("event_time").collect()
    assert [(bytes(row.key), row.epoch) for row in late] == [(b"B", 1), (b"A", 1)]
    assert {row.watermark_ms for row in late} == {ms(at(minutes=8, seconds=10))}
    assert bytes(late[1].value).decode() == line(at(minutes=7, seconds=59))
    assert feed.ledger() == [(1, 0, 1), (1, 2, 0)]


def test_the_watermark_never_falls(spark, feed):
    for minutes in (10, 3, 9, 30, 27, 29):
        feed.land(line(at(minutes=minutes)))
    feed.land("junk")
    feed.land(line(at(minutes=28, seconds=59)), line(at(minutes=26)))
    feed.route()
    marks = [row.watermark_ms for row in route_ledger(spark, feed.root).orderBy("epoch").collect()]
    assert marks[0] is None
    assert marks[1:] == sorted(marks[1:])
    feed.count()
    assert sum(feed.counts().values()) + late_records(spark, feed.root).count() == 8
    assert feed.counts() == {"12:10": 1, "12:09": 1, "12:30": 1, "12:29": 1, "12:28": 1}


def test_kept_and_late_are_all_after_restarts(spark, feed):
    """Each phase is a run of its own, of both streams."""
    landed = 0
    for phase in range(4):
        for minute in range(0, 12, 3):
            lines = [line(at(minutes=12 * phase + minute - lag)) for lag in (0, 1, 4, 20)]
            feed.land(*lines)
            landed += len(lines)
        feed.route()
        feed.count()
    late = late_records(spark, feed.root).count()
    assert late > 0
    assert sum(feed.counts().values()) + late == landed
    assert sum(kept + late + unread for kept, late, unread in feed.ledger()) == landed


def test_a_repeated_batch_splits_the_same_way(spark, feed, monkeypatch):
    """The batch fails after its files, before its ledger entry, and is repeated when the minutes have read them."""
    feed.land(line(at(minutes=10), trade_id="1"))
    feed.route()
    feed.land(line(at(minutes=10, seconds=5), trade_id="2"), line(at(minutes=1), trade_id="3"))

    def crash(*_):
        raise OSError("before the ledger")

    with monkeypatch.context() as patch:
        patch.setattr("tapemill.sinks.files.Folder.replace_text", crash)
        with pytest.raises(Exception, match="before the ledger"):
            feed.route()
    feed.count(once=True)
    feed.route()
    feed.count(once=True)
    assert feed.counts() == {"12:10": 2}
    assert feed.ledger() == [(1, 0, 0), (1, 1, 0)]
    assert late_records(spark, feed.root).count() == 1


def test_before_the_first_batch(spark, tmp_path):
    assert late_records(spark, str(tmp_path / "none")).count() == 0
    assert route_ledger(spark, str(tmp_path / "none")).count() == 0


def test_from_the_command_line(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.txt").write_text("\n".join([line(NOON), line(at(minutes=1)), "junk"]))
    common = ["--available-now", "--checkpoint"]
    main(["route", "--files", str(landing), "--to", str(tmp_path / "routes"), *common, str(tmp_path / "cp1")])
    table = ["--table", str(tmp_path / "minutes")]
    main(["minutes", "--routed", str(tmp_path / "routes"), *table, *common, str(tmp_path / "cp2")])
    assert BarTable(spark, str(tmp_path / "minutes")).read().count() == 2
