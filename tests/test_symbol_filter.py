"""One symbol of many: how much of a table is read for it."""

import pytest
from helpers import NOON, at, bars
from pyspark.sql import functions as F

from tapemill.functions import since
from tapemill.operators.panels import panel_1h
from tapemill.operators.timerange import from_time
from tapemill.sinks import BarTable
from tapemill.sinks.table import SYMBOL_FILTER

SYMBOLS, MINUTES = 1000, 30


@pytest.fixture(scope="module")
def minutes(spark, tmp_path_factory):
    """A thousand symbols in one hour, with every other name left out, in many small row groups."""
    table = BarTable(spark, str(tmp_path_factory.mktemp("bars")), **{"parquet.block.size": "65536"})
    rows = bars(spark, [("X", NOON, 1, 1, 1)]).drop("symbol", "window_start_ts", "price_avg")
    keys = spark.range(SYMBOLS * MINUTES).select(
        F.format_string("S%05d", 2 * (F.col("id") % SYMBOLS)).alias("symbol"),
        F.timestamp_seconds(F.lit(int(NOON.timestamp())) + 60 * F.expr(f"id DIV {SYMBOLS}")).alias("window_start_ts"),
        F.rand(3).cast("decimal(18,8)").alias("price_avg"),
    )
    table.upsert(keys.crossJoin(F.broadcast(rows)), keyed=True)
    return table


def rows_scanned(frame):
    """Rows that came out of the files, by the metric of the scan of a plan without a shuffle."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_panel_of_one_symbol_reads_few_row_groups(minutes):
    whole = minutes.read()
    assert rows_scanned(whole.select("symbol", "price_avg")) == SYMBOLS * MINUTES
    assert panel_1h(whole, at(minutes=MINUTES), "S00500").count() == MINUTES
    hour = from_time(whole, since(at(minutes=MINUTES), "1 HOUR"))
    assert MINUTES <= rows_scanned(hour.where("symbol = 'S00500'")) < SYMBOLS * MINUTES / 4


def test_a_symbol_that_is_not_there_reads_nothing(minutes, spark, tmp_path):
    """Its name lies between those that are, so only the Bloom filters tell."""
    assert rows_scanned(minutes.read().where("symbol = 'S00501'")) == 0
    # Of two files without dictionaries, which tell as much while a row group has few symbols, one has the filters.
    plain = {"parquet.block.size": "65536", "parquet.enable.dictionary": "false"}
    found = []
    for name, options in (("plain", plain), ("filtered", SYMBOL_FILTER | plain)):
        rows = minutes.read().orderBy("symbol").coalesce(1)
        rows.write.options(**options).parquet(str(tmp_path / name))
        found.append(rows_scanned(spark.read.parquet(str(tmp_path / name)).where("symbol = 'S00501'")))
    assert found[0] > 0
    assert found[1] == 0


def test_an_upsert_keeps_the_filters(minutes):
    minutes.upsert(minutes.read().where("symbol < 'S00100'").drop("window_date", "window_hour"), keyed=True)
    assert rows_scanned(minutes.read().where("symbol = 'S00501'")) == 0
