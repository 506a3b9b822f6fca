"""Timestamped backups of bar tables, of which only changed partitions are copied."""

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.sinks.files import Folder
from tapemill.sinks.table import BarTable


def snapshot_tables(tables: dict[str, BarTable], folder: str, now: datetime | None = None) -> DataFrame:
    """Back up every table under `folder`/<table>; returns table, row count, first and last window of each backup.

    A partition is copied if the latest backup lacks its version. The manifest of the backup,
    `folder`/<table>/_manifests/backup_<UTC time>.json, names the version of each partition and what its copy
    holds, so older partitions are neither copied nor read again. Figures are those of the copies. A repeated
    run with the same `now` writes its manifest anew.
    """
    now = now or datetime.now(timezone.utc)
    stamp = (now.astimezone(timezone.utc) if now.tzinfo else now).strftime("%Y%m%d_%H%M%S")
    spark = next(iter(tables.values())).spark
    rows = []
    for name, table in tables.items():
        store = Folder(spark, f"{folder.rstrip('/')}/{name}")
        known = _latest(store)
        live = table.partitions()
        changed = {part: version for part, version in live.items() if known.get(part, {}).get("version") != version}
        known = {part: entry for part, entry in known.items() if part in live} | _copied(table, store, changed)
        store.write_text(json.dumps(known), "_manifests", f"backup_{stamp}.json")
        rows.append((name, *_totals(known)))
    summary = spark.createDataFrame(rows, "table_name string, row_cnt bigint, first bigint, last bigint")
    times = [F.timestamp_micros("first").alias("first_window"), F.timestamp_micros("last").alias("last_window")]
    return summary.select("table_name", "row_cnt", *times)


def restored(table: BarTable, folder: str, name: str, stamp: str) -> DataFrame:
    """All rows of a table as a backup holds them."""
    store = Folder(table.spark, f"{folder.rstrip('/')}/{name}")
    entries = json.loads(store.read_text("_manifests", f"backup_{stamp}.json"))
    live = {part: entry["version"] for part, entry in entries.items()}
    return table.versioned(live, store.root).drop("version", *table.parts)


def _latest(store: Folder) -> dict[str, dict]:
    manifests = store.glob("_manifests/backup_*.json")
    return json.loads(store.read_text(manifests[-1])) if manifests else {}


def _copied(table: BarTable, store: Folder, changed: dict[str, int]) -> dict[str, dict]:
    """Copy the partitions; what their copies hold."""
    if not changed:
        return {}
    writer = table.versioned(changed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("version", *table.parts).parquet(store.root)
    names = [F.col(name).cast("string").alias(name) for name in table.parts]
    found = table.versioned(changed, store.root).groupBy("version", *names).agg(
        F.count(F.lit(1)).alias("rows"),
        F.unix_micros(F.min("window_start_ts")).alias("first"),
        F.unix_micros(F.max("window_start_ts")).alias("last"),
    )
    entries = {}
    for row in found.collect():
        part = "/".join(f"{name}={row[name]}" for name in table.parts)
        entries[part] = {name: row[name] for name in ("version", "rows", "first", "last")}
    return entries


def _totals(entries: dict[str, dict]) -> tuple[int, int | None, int | None]:
    firsts = [entry["first"] for entry in entries.values()]
    lasts = [entry["last"] for entry in entries.values()]
    return sum(entry["rows"] for entry in entries.values()), min(firsts, default=None), max(lasts, default=None)
