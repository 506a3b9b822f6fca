"""The continuous job over a file source."""

import os

import pytest
from helpers import NOON, at, ms
from pyspark.sql import functions as F

from tapemill.operators.bars import minute_bars
from tapemill.operators.trades import encode_trades, parse_trades
from tapemill.plans.event_feed import read_event_trades
from tapemill.schemas import KEYS, MEASURES, TRADE_SCHEMA
from tapemill.sinks import BarTable
from tapemill.sources import read_messages, read_trade_stream
from tapemill.streaming import start_minute_stream

EVENTS = "/root/testdata/sf0.001"


class Job:
    """A landing folder of text files, one micro-batch per file, and the table behind it."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.landing = folder / "landing"
        self.landing.mkdir()
        self.table = BarTable(spark, str(folder / "table"))
        self.files = 0

    def land(self, *trades):
        lines = [f'{{"ts":{ms(t)},"symbol":"{s}","price":{p},"qty":{q},"side":"buy"}}' for t, s, p, q in trades]
        self.land_lines(lines)

    def land_lines(self, lines):
        """The file source orders files by modification time: keep those apart."""
        path = self.landing / f"{self.files:04d}.txt"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def run(self):
        messages = read_trade_stream(
            self.spark, "text", str(self.landing), maxFilesPerTrigger="1", latestFirst="false"
        )
        query = start_minute_stream(messages, self.upsert, str(self.folder / "checkpoint"), available_now=True)
        query.awaitTermination()
        return query

    def upsert(self, batch):
        self.table.upsert(batch, NOON)

    def counts(self):
        out = self.table.read().select("symbol", F.date_format("window_start_ts", "HH:mm").alias("m"), "trade_cnt")
        return {(row.symbol, row.m): row.trade_cnt for row in out.collect()}


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


def test_update_mode_emits_whole_windows(job):
    job.land((NOON, "A", 1, 1), (at(seconds=5), "A", 3, 1))
    job.land((at(seconds=30), "A", 5, 1), (at(seconds=70), "B", 1, 1))
    job.run()
    assert job.counts() == {("A", "12:00"): 3, ("B", "12:01"): 1}
    assert job.table.read().where("symbol = 'A'").first().price_avg == 3


def test_late_data_is_dropped_per_window(job):
    """The watermark moves to 12:08; a batch in between lets the drop take effect."""
    job.land((at(minutes=5, seconds=59), "A", 1, 1), (at(minutes=10, seconds=10), "A", 1, 1))
    job.land((at(minutes=10, seconds=20), "A", 1, 1))
    # Watermark 12:08:10-20: 12:08:01 is older but its window is open; 12:07:59 lies in a closed one.
    job.land((at(minutes=8, seconds=1), "A", 1, 1), (at(minutes=7, seconds=59), "A", 1, 1))
    query = job.run()
    assert job.counts() == {("A", "12:05"): 1, ("A", "12:08"): 1, ("A", "12:10"): 2}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_within_two_minutes_is_kept(job):
    job.land((at(minutes=10), "A", 1, 1))
    job.land((at(minutes=10, seconds=1), "A", 1, 1))
    job.land((at(minutes=8, seconds=30), "A", 1, 1))
    job.run()
    assert job.counts()[("A", "12:08")] == 1


def test_restart_continues_from_the_checkpoint(job):
    job.land((NOON, "A", 1, 1))
    job.run()
    job.land((at(seconds=20), "A", 1, 1), (at(seconds=61), "A", 1, 1))
    job.run()
    job.run()
    assert job.counts() == {("A", "12:00"): 2, ("A", "12:01"): 1}


def test_failed_upsert_is_replayed(job):
    job.land((NOON, "A", 1, 1))
    keep, failures = job.upsert, []

    def failing(batch):
        keep(batch)
        if not failures:
            failures.append(1)
            raise OSError("after the write, before the commit")

    job.upsert = failing
    with pytest.raises(Exception, match="after the write"):
        job.run()
    job.run()
    assert job.counts() == {("A", "12:00"): 1}


def test_bad_records_do_not_stop_the_stream(job):
    job.land((NOON, "A", 1, 1))
    job.land_lines(["junk", '{"ts":1,"symbol":"A","price":null,"qty":1}'])
    job.run()
    assert job.counts() == {("A", "12:00"): 1}


def test_stream_equals_batch(spark, job):
    """Files in time order: nothing is late, so the streamed table equals one batch over the landed text."""
    records = encode_trades(read_event_trades(spark, EVENTS)).select("value")
    rows = records.select(F.col("value").cast("string"), F.get_json_object(F.col("value").cast("string"), "$.ts"))
    ordered = [row[0] for row in sorted(rows.collect(), key=lambda row: int(row[1]))]
    for i in range(0, len(ordered), 250):
        job.land_lines(ordered[i : i + 250])
    query = job.run()
    assert sum(progress["numInputRows"] > 0 for progress in query.recentProgress) == job.files == 4
    batch = minute_bars(parse_trades(read_messages(spark, str(job.landing))))
    streamed = job.table.read().select(*KEYS, *MEASURES)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert not batch.isEmpty()


def test_stream_plan_parses_once_and_shuffles_partial_sums(job):
    job.land((NOON, "A", 1, 1))
    text = job.run()._jsq.explainInternal(False)
    assert text.count("from_json") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text.split("Exchange hashpartitioning")[1]


def test_state_partitions_do_not_leak_into_the_session(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.land((NOON, "A", 1, 1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    messages = read_trade_stream(spark, "text", str(job.landing))
    query = start_minute_stream(
        messages, job.upsert, str(tmp_path / "checkpoint"), available_now=True, state_partitions=3
    )
    query.awaitTermination()
    assert query.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_kafka_records_keep_key_and_value(spark):
    trade = spark.createDataFrame([(1, "A", 1.0, 1.0, "buy")], TRADE_SCHEMA)
    assert dict(encode_trades(trade).dtypes) == {"key": "binary", "value": "binary"}


def test_a_record_out_of_time_costs_one_record(job):
    """Nanoseconds would overflow, microseconds would be a year that no partition can hold."""
    for factor in (1_000_000, 1_000):
        bad = f'{{"ts":{ms(NOON) * factor},"symbol":"A","price":1,"qty":1,"side":"buy"}}'
        good = f'{{"ts":{ms(NOON) + factor},"symbol":"A","price":1,"qty":1,"side":"buy"}}'
        job.land_lines([bad, good])
    job.run()
    assert sum(job.counts().values()) == 2
