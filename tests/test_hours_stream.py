"""Hours and rolling deviations as streams: each row once, when it is final."""

import os
from datetime import timedelta

import numpy as np
import pytest
from helpers import NOON, at, ms

from tapemill.operators.bars import hour_bars, minute_bars
from tapemill.operators.panels import rolling_std_history
from tapemill.operators.trades import parse_trades
from tapemill.schemas import KEYS, MEASURES
from tapemill.sources import read_messages, read_trade_stream
from tapemill.streaming import read_final_minutes, start_final_minutes, start_hour_stream, start_rolling_stream
from tapemill.streaming.rolling import deviations


def line(time, symbol="A", price=1, qty=1):
    return f'{{"ts":{ms(time)},"symbol":"{symbol}","price":{price},"qty":{qty},"side":"buy"}}'


def beat(time):
    return f'{{"ts":{ms(time)}}}'


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.files, self.out = spark, folder, 0, []
        self.landing = folder / "landing"
        self.landing.mkdir()

    def land(self, *lines):
        path = self.landing / f"{self.files:04d}.txt"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def messages(self):
        return read_trade_stream(self.spark, "text", str(self.landing), maxFilesPerTrigger="1")

    def hours(self, upsert=None):
        upsert = upsert or (lambda batch: self.out.extend(batch.collect()))
        start_hour_stream(self.messages(), upsert, str(self.folder / "cp"), available_now=True).awaitTermination()

    def rolling(self, write=None, idle=timedelta(days=7)):
        minutes = str(self.folder / "minutes")
        start_final_minutes(
            self.messages(), minutes, str(self.folder / "cp-minutes"), available_now=True
        ).awaitTermination()
        start_rolling_stream(
            read_final_minutes(self.spark, minutes),
            write or (lambda batch, _epoch: self.out.extend(batch.collect())),
            str(self.folder / "cp"),
            idle=idle,
            available_now=True,
        ).awaitTermination()

    def batch_minutes(self):
        return minute_bars(parse_trades(read_messages(self.spark, str(self.landing))))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def spread(feed, hours=3):
    """Trades of two symbols with gaps, one file for each quarter of an hour."""
    for quarter in range(4 * hours):
        lines = []
        for minute in range(15):
            for second in range(0, 60, 20):
                if (quarter * 15 + minute) % 7:
                    lines.append(line(at(minutes=quarter * 15 + minute, seconds=second), "A", minute + second / 7, 0.1))
                if minute % 4 == 0:
                    lines.append(line(at(minutes=quarter * 15 + minute, seconds=second), "B", quarter + minute / 3))
        feed.land(*lines)


def test_hours_come_out_once_and_equal_the_batch(feed):
    spread(feed)
    feed.hours()
    assert {row.window_start_ts.hour for row in feed.out} == {12, 13}
    feed.land(beat(at(hours=4)), "junk")
    feed.hours()
    expected = hour_bars(feed.batch_minutes()).select(*KEYS, *MEASURES).collect()
    assert len(feed.out) == len(expected) == 6
    assert set(map(tuple, feed.out)) == set(map(tuple, expected))


def test_a_heartbeat_is_no_trade(feed):
    feed.land(line(NOON), beat(at(seconds=30)))
    feed.land(beat(at(hours=2)))
    feed.hours()
    assert [(row.symbol, row.trade_cnt) for row in feed.out] == [("A", 1)]


def test_trades_of_closed_minutes_are_dropped(feed):
    feed.land(line(NOON), line(at(minutes=10)))
    feed.land(beat(at(minutes=11)))
    feed.land(line(at(minutes=3)), line(at(minutes=9)))
    feed.land(beat(at(hours=2)))
    feed.hours()
    # 12:03 was closed by the watermark 12:08; 12:09 was not.
    assert [row.trade_cnt for row in feed.out] == [3]


def test_a_failed_upsert_is_replayed(feed):
    spread(feed, hours=1)
    feed.land(beat(at(hours=3)))
    seen = []

    def failing(batch):
        seen.append(batch.collect())
        if seen[-1] and len([rows for rows in seen if rows]) == 1:
            raise OSError("after the write, before the commit")

    with pytest.raises(Exception, match="after the write"):
        feed.hours(failing)
    feed.hours(failing)
    first, again = [rows for rows in seen if rows][:2]
    assert sorted(first) == sorted(again)


def test_rolling_equals_the_batch_after_restarts(feed):
    spread(feed)
    feed.rolling()
    assert feed.out
    feed.land(beat(at(hours=4)))
    feed.rolling()
    expected = rolling_std_history(feed.batch_minutes()).collect()
    figures = [{(r.symbol, r.window_start_ts): r.rolling_std for r in rows} for rows in (feed.out, expected)]
    assert len(feed.out) == len(expected) == len(figures[0])
    assert figures[0].keys() == figures[1].keys()
    for key, value in figures[1].items():
        assert figures[0][key] == (None if value is None else pytest.approx(value, abs=1e-9))
    assert any(value is None for value in figures[1].values())


def test_a_replayed_batch_gives_the_same_figures(feed):
    spread(feed, hours=1)
    feed.land(beat(at(hours=3)))
    seen = {}

    def failing(batch, epoch):
        rows = sorted(map(str, batch.collect()))
        again = epoch in seen
        assert seen.setdefault(epoch, rows) == rows
        if rows and not again:
            raise OSError("before the commit")

    for _ in range(30):
        try:
            feed.rolling(failing)
            break
        except Exception as error:
            assert "before the commit" in str(error)
    assert sum(map(len, seen.values())) == feed.batch_minutes().count()


@pytest.mark.parametrize("at_once", [True, False])
def test_idle_symbols_start_anew(feed, at_once):
    for start in (0, 120, 180):
        for minute in range(6):
            feed.land(line(at(minutes=start + minute), "A", minute))
        # Another symbol moves the time on, so A's state expires in the first gap.
        for minute in range(0, 60, 10):
            feed.land(line(at(minutes=start + 30 + minute), "B", 1))
        if not at_once:
            feed.rolling(idle=timedelta(minutes=70))
    feed.land(beat(at(hours=9)))
    feed.rolling(idle=timedelta(minutes=70))
    of_a = {(r.window_start_ts - NOON.replace(tzinfo=None)) // timedelta(minutes=1): r.rolling_std for r in feed.out if r.symbol == "A"}
    assert [minute for minute, value in sorted(of_a.items()) if value is None] == [0, 1, 2, 3, 120, 121, 122, 123]


def test_deviations():
    values = np.array([3.0, 1.0, 4.0, 1.0, 5.0])
    assert np.isnan(deviations(values, 6)).all()
    assert np.isnan(deviations(values[:0], 5)).all()
    made = deviations(values, 3)
    assert np.isnan(made[:2]).all()
    assert made[2:] == pytest.approx([np.std(values[i : i + 3], ddof=1) for i in range(3)])
    gapped = deviations(values, 3, np.array([0, 1, 2, 9, 10]), 5)
    assert np.isnan(gapped).tolist() == [True, True, False, True, True]


def test_one_shuffle_for_each_level(feed):
    feed.land(line(NOON))
    query = start_hour_stream(feed.messages(), lambda batch: batch.collect(), str(feed.folder / "cp"), available_now=True)
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("from_json") == 1
    assert text.count("partial_sum") >= 2
