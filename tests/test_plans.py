"""Plans: what is pushed down, what is shuffled, and that no Python runs on rows."""

import pytest
from helpers import NOON, at, bars, plan

from tapemill.functions.temporal import since
from tapemill.operators import panels
from tapemill.operators.bars import rollup_1h
from tapemill.operators.timerange import from_time
from tapemill.operators.trades import classify_messages, normalize_trades, parse_trades
from tapemill.plans.registry import registered_queries as queries
from tapemill.sinks import BarTable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bars")
    bars(spark, [(s, at(minutes=-m), 1, 1, 1) for s in "AB" for m in range(90)]).write.parquet(path)
    return spark.read.parquet(path)


def scan(frame):
    return [line for line in plan(frame).splitlines() if "FileScan" in line][0]


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(queries()[name](spark, SF))
    for node in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in text


@pytest.mark.parametrize("build", [normalize_trades, parse_trades])
def test_each_record_is_parsed_once(spark, tmp_path, build):
    (tmp_path / "a.txt").write_text("{}")
    text = plan(build(spark.read.text(str(tmp_path))))
    assert text.count("from_json") == 1


def test_classifying_scans_parses_and_casts_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("{}")
    text = plan(classify_messages(spark.read.text(str(tmp_path))))
    assert text.count("FileScan") == text.count("from_json") == 1
    generated = text.split("Generate")[1].splitlines()[0]
    # Two for price, two for quantity, one for the maker flag.
    assert generated.count("try_cast") <= 5


def test_minute_bars_shuffle_partial_aggregates_once(spark):
    text = plan(queries()["agg_1m"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text.split("Exchange hashpartitioning")[1]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in text


def test_panel_filters_reach_the_scan(stored):
    pushed = scan(panels.kpis_1h(stored, NOON, "A"))
    assert "EqualTo(symbol,A)" in pushed
    assert "GreaterThanOrEqual(window_start_ts,2024-03-05 11:00:00" in pushed
    assert "volume_sum" not in pushed.split("ReadSchema:")[1]
    rollup = scan(rollup_1h(stored, NOON))
    assert "LessThan(window_start_ts,2024-03-05 13:00:00" in rollup
    clock = scan(from_time(stored, since(None, "30 MINUTES")))
    assert "GreaterThanOrEqual(window_start_ts," in clock


def test_top_ten_is_cut_before_the_shuffle(stored):
    assert "TakeOrderedAndProject(limit=10" in plan(panels.panel_recent(stored, NOON, "A"))
    ranked = plan(panels.panel_recent(stored, NOON))
    assert "WindowGroupLimit" in ranked.split("Exchange hashpartitioning")[1]


def test_history_windows_are_cut_by_chunk(spark):
    frame = queries()["rolling_std_history"](spark, SF)
    frame.collect()
    text = plan(frame)
    assert "ReusedExchange" in text or text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["kpis_1h", "rollup_1h", "dq_recent_30m", "panel_recent"])
def test_trailing_queries_restrict_the_scan_of_trades(spark, name):
    assert "GreaterThanOrEqual(ts,2024-01" in scan(queries()[name](spark, SF))


def test_an_upsert_shuffles_only_for_its_files(spark, tmp_path):
    """A small batch is broadcast by its measured file size; the stored rows move once, to even out files."""
    table = BarTable(spark, str(tmp_path / "table"), "hour")
    table.upsert(bars(spark, [(s, at(minutes=-m), 1, 1, 1) for s in "AB" for m in range(600)]))
    path = str(tmp_path / "batch")
    table.read().limit(10).write.parquet(path)
    number, live = table._pointer()
    assert number == 1
    text = plan(table._merged(spark.read.schema(table._ddl).parquet(path), live))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert text.count("Exchange hashpartitioning") == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in text
