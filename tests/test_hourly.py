"""The hourly chain."""

import pytest
from helpers import NOON, at, bars
from pyspark.sql import functions as F

from tapemill.operators.quality import DataQualityError
from tapemill.plans import run_hourly
from tapemill.sinks import BarTable


@pytest.fixture
def tables(spark, tmp_path):
    return BarTable(spark, str(tmp_path / "m")), BarTable(spark, str(tmp_path / "h")), str(tmp_path / "backups")


def hours(table):
    out = table.read().select(F.date_format("window_start_ts", "dd HH").alias("h"), "trade_cnt")
    return {row.h: row.trade_cnt for row in out.collect()}


def test_chain_rewrites_two_hours_and_snapshots(spark, tables, tmp_path):
    minutes, by_hour, backups = tables
    minutes.upsert(bars(spark, [("A", at(minutes=-m), 1, 1, 1) for m in range(1, 181)]))
    manifest = {row.table_name: row.row_cnt for row in run_hourly(minutes, by_hour, backups, at(minutes=-1)).collect()}
    assert hours(by_hour) == {"05 10": 60, "05 11": 60}
    assert manifest == {"trade_agg_1m": 180, "trade_agg_1h": 2}
    minutes.upsert(bars(spark, [("A", NOON, 7, 1, 1), ("A", at(minutes=-1), 5, 1, 1)]))
    run_hourly(minutes, by_hour, backups, at(minutes=1))
    assert hours(by_hour) == {"05 10": 60, "05 11": 64, "05 12": 7}
    assert (tmp_path / "backups" / "trade_agg_1h" / "_manifests" / "backup_20240305_115900.json").exists()


def test_the_previous_hour_may_lie_on_the_day_before(spark, tables):
    minutes, by_hour, backups = tables
    minutes.upsert(bars(spark, [("A", at(hours=12, minutes=m), 1, 1, 1) for m in (-2, -1, 0, 1)]))
    run_hourly(minutes, by_hour, backups, at(hours=12, minutes=2))
    assert hours(by_hour) == {"05 23": 2, "06 00": 2}


def test_stale_table_stops_rollup_and_snapshot(spark, tables, tmp_path):
    minutes, by_hour, backups = tables
    minutes.upsert(bars(spark, [("A", at(hours=-1), 1, 1, 1)]))
    with pytest.raises(DataQualityError):
        run_hourly(minutes, by_hour, backups, NOON)
    assert by_hour.read().isEmpty()
    assert not (tmp_path / "backups").exists()
