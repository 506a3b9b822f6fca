"""A stored table as a view: SQL gives the frames' answers and is pushed down the same way."""

from helpers import NOON, at, bars, plan

from tapemill.operators import panels
from tapemill.operators.quality import freshness_report
from tapemill.sinks import BarTable

CLOCK = "TIMESTAMP '2024-03-05 12:00:00'"


def test_sql_over_a_stored_table(spark, tmp_path):
    table = BarTable(spark, str(tmp_path), "hour")
    table.upsert(bars(spark, [(s, at(minutes=-m), m, 1, m + 1) for s in ("A", "B") for m in range(180)]))
    table.read().createOrReplaceTempView("minutes")
    totals = spark.sql(
        f"""SELECT symbol, max(price_max) AS max_price, sum(trade_cnt) AS trade_count FROM minutes
            WHERE window_start_ts >= {CLOCK} - INTERVAL '1 hour' AND window_date >= date'2024-03-05' GROUP BY ALL"""
    )
    frames = panels.kpis_1h(table.read(), NOON).select("symbol", "max_price", "trade_count")
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, frames.collect()))
    assert "GreaterThanOrEqual(window_start_ts,2024-03-05 11:00:00" in plan(totals)
    assert "window_date" in plan(totals).split("PartitionFilters:")[1].split("]")[0]
    fresh = spark.sql(f"SELECT count(*) FROM minutes WHERE window_start_ts >= {CLOCK} - INTERVAL '30 minutes'")
    assert fresh.first()[0] == freshness_report(table.read(), NOON).first().cnt == 62
