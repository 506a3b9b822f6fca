"""The hourly job: freshness gate, rollup, snapshot."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame

from tapemill.operators.bars import rollup_1h
from tapemill.operators.quality import require_fresh
from tapemill.sinks.snapshot import snapshot_tables
from tapemill.sinks.table import BarTable


def run_hourly(
    minutes: BarTable, hours: BarTable, backup_folder: str, now: datetime | None = None
) -> DataFrame:
    """Run the three steps in order; a stale minute table raises and stops the rest.

    Only the previous and the current hour are rewritten. Pass an earlier `now` to redo a missed run.
    """
    now = now or datetime.now(timezone.utc)
    recent = minutes.read(since=now - timedelta(hours=2))
    require_fresh(recent, now)
    hours.upsert(rollup_1h(recent, now), now)
    return snapshot_tables({"trade_agg_1m": minutes, "trade_agg_1h": hours}, backup_folder, now)
