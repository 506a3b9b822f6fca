"""Moments per hour, merged over long ranges."""

import random
import statistics
from datetime import timedelta

import pytest
from helpers import NOON, at, bars, plan

from tapemill.operators.moments import (
    hour_moments,
    merged_moments,
    read_moments,
    volatility,
    volatility_between,
    write_moments,
)
from tapemill.sinks import BarTable


def prices(n, seed=1, level=100.0):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        level += rng.gauss(0, 1)
        made.append(round(level, 8))
    return made


@pytest.fixture
def table(spark, tmp_path):
    """Three days of minutes with gaps, of two symbols, one of them at a high level."""
    rows = []
    for symbol, level in (("A", 100.0), ("B", 9_000_000.0)):
        for i, price in enumerate(prices(3 * 1440, level=level)):
            if i % 11 and (symbol == "A" or i % 3):
                rows.append((symbol, at(minutes=i), 1, 1, price, price - 1, price + 2))
    made = BarTable(spark, str(tmp_path / "minutes"))
    made.upsert(bars(spark, rows), keyed=True)
    return made, rows


def expected(rows, first, last):
    found = {}
    for symbol in {row[0] for row in rows}:
        own = [row for row in rows if row[0] == symbol and first <= row[1] < last]
        if own:
            means = [row[4] for row in own]
            spread = max(row[6] for row in own) - min(row[5] for row in own)
            deviation = statistics.stdev(means) if len(means) > 1 else None
            found[symbol] = (len(own), deviation, spread / statistics.fmean(means) * 100)
    return found


def result(frame):
    return {row["symbol"]: (row["minutes"], row["std_dev"], row["vol_rate"]) for row in frame.collect()}


def same(found, wanted):
    assert found.keys() == wanted.keys()
    for symbol, (minutes, deviation, rate) in wanted.items():
        assert found[symbol][0] == minutes
        assert found[symbol][1] == (None if deviation is None else pytest.approx(deviation, rel=1e-9))
        assert found[symbol][2] == pytest.approx(rate, rel=1e-9)


@pytest.mark.parametrize(
    ("first", "last"),
    [
        (timedelta(0), timedelta(days=3)),
        (timedelta(hours=5), timedelta(hours=50)),
        (timedelta(minutes=17), timedelta(hours=30, minutes=43)),
        (timedelta(hours=1, minutes=10), timedelta(hours=1, minutes=50)),
        (timedelta(hours=1, minutes=10), timedelta(hours=2, minutes=5)),
        (timedelta(hours=2), timedelta(hours=2, minutes=5)),
        (timedelta(minutes=1), timedelta(minutes=2)),
        (timedelta(days=9), timedelta(days=10)),
        (timedelta(hours=3), timedelta(hours=2)),
    ],
)
def test_ranges_equal_the_minutes(spark, table, tmp_path, first, last):
    store, rows = table
    folder = str(tmp_path / "moments")
    write_moments(store.read(), folder)
    found = volatility_between(read_moments(spark, folder), store.read(), NOON + first, NOON + last)
    same(result(found), expected(rows, NOON + first, NOON + last))


def test_only_cut_hours_are_read(spark, table, tmp_path):
    store, _ = table
    folder = str(tmp_path / "moments")
    write_moments(store.read(), folder)
    moments = read_moments(spark, folder)
    whole = plan(volatility_between(moments, store.read(), NOON, NOON + timedelta(hours=48)))
    assert "window_start_ts" not in whole
    cut = volatility_between(moments, store.read(), NOON + timedelta(minutes=1), NOON + timedelta(hours=48, minutes=1))
    assert "window_hour" in plan(cut).split("PartitionFilters")[2]


def test_dates_are_replaced(spark, table, tmp_path):
    store, rows = table
    folder = str(tmp_path / "moments")
    write_moments(store.read(), folder)
    day = (NOON + timedelta(days=1)).date().isoformat()
    changed = store.read().where(f"window_date = '{day}' AND minute(window_start_ts) < 30")
    write_moments(changed, folder)
    kept = [row for row in rows if row[1].date().isoformat() != day or row[1].minute < 30]
    same(result(volatility(merged_moments(read_moments(spark, folder)))), expected(kept, NOON, at(days=9)))


def test_merging_is_associative(spark, table):
    store, _ = table
    moments = hour_moments(store.read())
    by_part = moments.selectExpr("*", "hour(hour) % 5 AS part")
    twice = merged_moments(merged_moments(by_part, "symbol", "part"))
    once = result(volatility(merged_moments(moments)))
    for symbol, figures in result(volatility(twice)).items():
        assert figures == pytest.approx(once[symbol], rel=1e-10)


def test_edge_cases(spark):
    empty = hour_moments(bars(spark, []))
    assert volatility(merged_moments(empty)).count() == 0
    rows = [("A", NOON, 1, 1, 5), ("Z", NOON, 1, 1, 0), ("Z", at(minutes=1), 1, 1, 0)]
    found = result(volatility(merged_moments(hour_moments(bars(spark, rows)))))
    assert found == {"A": (1, None, 0.0), "Z": (2, 0.0, None)}
