"""Gaps per symbol."""

import random
from datetime import timedelta

import pytest
from helpers import NOON, at, bars, minutes_before, plan

from tapemill.operators.outages import outages, require_symbols_fresh, symbol_freshness
from tapemill.operators.quality import DataQualityError, freshness_report
from tapemill.sinks import BarTable


def feed(spark, starts):
    """Minutes of each symbol, given as minutes after noon."""
    return bars(spark, [(symbol, at(minutes=m), 1, 1, 1) for symbol, own in starts.items() for m in own])


def found(frame):
    """Gaps as minutes after noon."""
    def number(time):
        return None if time is None else int((time - NOON.replace(tzinfo=None)) / timedelta(minutes=1))

    return {(r.symbol, number(r.silent_from), number(r.silent_until), r.ongoing, r.silent_minutes) for r in frame.collect()}


def test_gaps_and_dead_symbols(spark):
    minutes = feed(spark, {"A": [0, 1, 40, 41, 200], "B": [0, 30, 60], "C": [*range(0, 201, 10)]})
    assert found(outages(minutes, at(minutes=200))) == {
        ("A", 2, 40, False, 38),
        ("A", 42, 200, False, 158),
        ("B", 61, None, True, 139),
    }
    # The gate sees a row of another symbol and is content.
    assert freshness_report(minutes, at(minutes=200)).first()["fresh"]


@pytest.mark.parametrize(("step", "gaps"), [(29, 0), (30, 0), (31, 1)])
def test_a_gap_is_longer_than_the_limit(spark, step, gaps):
    assert outages(feed(spark, {"A": [0, step]}), at(minutes=step)).count() == gaps
    # At the end of the feed the clock takes the place of the next minute.
    assert outages(feed(spark, {"A": [0]}), at(minutes=step)).count() == gaps


def test_against_a_loop(spark):
    rng = random.Random(4)
    starts = {f"S{k}": sorted(rng.sample(range(1000), rng.choice((1, 2, 20, 60)))) for k in range(30)}
    now, expected = 990, set()
    for symbol, own in starts.items():
        seen = [m for m in own if m <= now]
        for a, b in zip(seen, [*seen[1:], None], strict=True):
            if (now if b is None else b) - a > 30:
                expected.add((symbol, a + 1, b, b is None, (now if b is None else b) - a - 1))
    assert found(outages(feed(spark, starts), at(minutes=now))) == expected


def test_edge_cases(spark):
    assert outages(feed(spark, {}), NOON).count() == 0
    later = feed(spark, {"A": [50]})
    assert outages(later, NOON).count() == 0
    assert symbol_freshness(later, NOON).count() == 0


def test_freshness_by_symbol(spark):
    minutes = feed(spark, {"A": [0, 60], "B": [0, 29], "C": [30]})
    rows = symbol_freshness(minutes, at(minutes=60)).collect()
    assert {(r.symbol, r.fresh) for r in rows} == {("A", True), ("B", False), ("C", True)}


def test_the_gate_names_dead_symbols(spark, tmp_path):
    table = BarTable(spark, str(tmp_path / "minutes"))
    table.upsert(minutes_before(spark, [1] * 5, "A").unionByName(minutes_before(spark, [1] * 5, "B", at(hours=-2))))
    table.upsert(minutes_before(spark, [1] * 5, "OLD", at(days=-3)))
    with pytest.raises(DataQualityError, match="for: B$"):
        require_symbols_fresh(table.read(), NOON)
    require_symbols_fresh(table.read(), at(hours=-2))


def test_runs_are_merged_by_session_windows(spark):
    text = plan(outages(feed(spark, {"A": [0, 1, 40]}), NOON))
    assert "MergingSessions" in text or "UpdatingSessions" in text
