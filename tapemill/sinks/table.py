"""A keyed bar table in parquet, replaced partition by partition.

Parquet has no MERGE, and overwriting partitions in place leaves readers (and a crash) with half a table. So
an upsert writes the touched partitions, merged, to a fresh `version=N` folder; a small pointer file then names
the version each partition is read from. Readers see the table before or after an upsert, never between, and
may go on with what they opened for the retention time. One writer per table: the stream writes the minutes,
the hourly job the hours.
"""

import json
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapemill.functions import utc_date, utc_hour
from tapemill.functions.temporal import Now
from tapemill.operators.contract import ANY_NULL, check_contract, conform_bars
from tapemill.schemas import BAR_SCHEMA, KEYS
from tapemill.sinks.files import Folder

PARTITIONING = {
    "day": ["window_date"],
    "hour": ["window_date", "window_hour"],
}
# Rows are sorted by symbol, so a row group holds few; its Bloom filter tells whether one between its first and last is
# among them. Sized for so many symbols to a row group.
SYMBOLS = 10_000
SYMBOL_FILTER = {
    "parquet.bloom.filter.enabled#symbol": "true",
    "parquet.bloom.filter.expected.ndv#symbol": str(SYMBOLS),
}
# Staged rows older than this belong to no living writer.
ABANDONED = timedelta(days=1)
_POINTERS = "_current/*.json"
_PARTITION_TYPES = {"window_date": "date", "window_hour": "int"}


def _partition_value(name: str) -> Column:
    ts = F.col("window_start_ts")
    return utc_date(ts) if name == "window_date" else utc_hour(ts)


def _pointer_name(version: int) -> str:
    return f"{version:012d}.json"


class BarTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        partition_by: str = "hour",
        retain: timedelta = timedelta(hours=1),
        **options: str,
    ):
        """`partition_by` "hour" keeps the rewrite of a micro-batch small; "day" has fewer folders.

        It counts for a new table; an existing one keeps its partitioning. `retain` is how long a replaced
        partition stays readable: longer than the longest query over the table. `options` go to the Parquet writer,
        e.g. **{"parquet.block.size": "33554432"} for smaller row groups where many symbols are read singly.
        """
        self.spark = spark
        self.options = SYMBOL_FILTER | options
        self.retain_ms = retain // timedelta(milliseconds=1)
        self.folder = Folder(spark, root)
        existing = next(iter(self._pointer()[1]), None)
        self.parts = PARTITIONING[partition_by]
        if existing:
            self.parts = [part.split("=")[0] for part in existing.split("/")]
        columns = [f"{field.name} {field.dataType.simpleString()}" for field in BAR_SCHEMA]
        self._ddl = ", ".join(columns + [f"{name} {_PARTITION_TYPES[name]}" for name in self.parts])

    def read(self, since: datetime | None = None) -> DataFrame:
        """The current rows with their partition columns; `since` (UTC) spares listing older dates."""
        live = self._pointer()[1]
        if since is not None:
            utc = since if since.tzinfo is None else since.astimezone(timezone.utc)
            oldest = f"window_date={utc.date().isoformat()}"
            live = {part: version for part, version in live.items() if part.split("/")[0] >= oldest}
        return self._load(live)

    def upsert(self, bars: DataFrame, now: Now = None, keyed: bool = False) -> None:
        """Insert the rows; on an existing key replace all measures and `updated_at`. Repeatable.

        The rows are first written to a staging folder, so a streaming micro-batch is computed once and
        the merge no longer depends on it; nulls and touched partitions are observed in that pass. No row passes
        through the driver. `keyed` says that keys are known to occur once, as those of a grouping do; they are then
        not read again and shuffled to be counted.
        """
        self._remove_abandoned()
        staging = f"_staging/{uuid.uuid4().hex}"
        conformed = conform_bars(bars, now).withColumns({name: _partition_value(name) for name in self.parts})
        seen = self._staged(conformed, self.folder.path(staging))
        try:
            staged = self.spark.read.schema(self._ddl).parquet(self.folder.path(staging))
            touched = self._touched(staged, keyed, seen)
            if touched:
                self._replace(staged, touched)
        finally:
            self.folder.remove(staging)

    def _remove_abandoned(self) -> None:
        """Staged rows of writers that died; those of a living one are younger."""
        oldest = (datetime.now(timezone.utc) - ABANDONED).timestamp() * 1000
        for name, changed in self.folder.modified("_staging/*").items():
            if changed < oldest:
                self.folder.remove(name)

    def _staged(self, rows: DataFrame, path: str) -> dict:
        """Write the rows; folders of the partitions they belong to, and how many of them have a null."""
        names = [F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in self.parts]
        seen = Observation()
        rows.observe(
            seen, F.collect_set(F.concat_ws("/", *names)).alias("touched"), F.count_if(F.expr(ANY_NULL)).alias("nulls")
        ).write.parquet(path)
        return seen.get

    def _touched(self, staged: DataFrame, keyed: bool, seen: dict) -> list[str]:
        """Folders of the partitions the staged rows belong to, once they are known to keep the contract."""
        if seen["nulls"] or not keyed:
            check_contract(staged)
        return sorted(seen["touched"])

    def _replace(self, staged: DataFrame, touched: list[str]) -> None:
        number, live = self._pointer()
        stale = {part: live[part] for part in touched if part in live}
        # A crashed attempt may have left a folder the pointer does not name: never write into one.
        version = max([number, *self._versions()]) + 1
        merged = self._merged(staged, stale)
        merged.write.options(**self.options).partitionBy(*self.parts).parquet(self.folder.path(f"version={version}"))
        if self._pointer()[0] != number:
            raise RuntimeError(f"{self.folder.root} was changed by another writer; repeat the upsert")
        self._publish(version, live | dict.fromkeys(touched, version))

    def _merged(self, staged: DataFrame, stale: dict[str, int]) -> DataFrame:
        """The staged rows, and those of the stale partitions they do not replace; files of an even size."""
        kept = self._load(stale).join(staged.select(*KEYS), KEYS, "left_anti")
        rows = kept.unionByName(staged) if stale else staged
        return rows.hint("rebalance", *self.parts).sortWithinPartitions(*self.parts, *KEYS)

    def _publish(self, version: int, live: dict[str, int]) -> None:
        """Switch readers over, then drop what no reader within the retention time can have opened."""
        self.folder.write_text(json.dumps(live), "_current", _pointer_name(version))
        published = self.folder.modified(_POINTERS)
        names, times = [path.split("/")[-1] for path in published], list(published.values())
        # A pointer was in use until the next one came, and the one before the newest until just now.
        kept = len(names) - 2
        while kept > 0 and times[-1] - times[kept] <= self.retain_ms:
            kept -= 1
        if kept <= 0:
            return
        # A partition once replaced never comes back, so the oldest kept pointer tells what later ones need.
        needed = set(self._read_pointer(names[kept]).items())
        for name in names[:kept]:
            for part, number in set(self._read_pointer(name).items()) - needed:
                self.folder.remove(f"version={number}", part)
            self.folder.remove("_current", name)
        in_use = {number for _, number in needed}
        for number in self._versions():
            if _pointer_name(number) < names[kept] and number not in in_use:
                self.folder.remove(f"version={number}")

    def _versions(self) -> list[int]:
        return [int(name.split("=")[1]) for name in self.folder.glob("version=*")]

    def _pointers(self) -> list[str]:
        return [path.split("/")[-1] for path in self.folder.glob(_POINTERS)]

    def _read_pointer(self, name: str) -> dict[str, int]:
        return json.loads(self.folder.read_text("_current", name))

    def _pointer(self) -> tuple[int, dict[str, int]]:
        """Number of the last upsert, and the version every partition is read from."""
        names = self._pointers()
        return (int(names[-1].removesuffix(".json")), self._read_pointer(names[-1])) if names else (0, {})

    def partitions(self) -> dict[str, int]:
        """The version that each partition is read from."""
        return self._pointer()[1]

    def versioned(self, live: dict[str, int], root: str | None = None) -> DataFrame:
        """Rows of the named partitions with their version; from a copy of the table, if it is elsewhere."""
        ddl, root = f"{self._ddl}, version int", root or self.folder.root
        if not live:
            return self.spark.createDataFrame([], ddl)
        paths = [f"{root}/version={version}/{part}" for part, version in live.items()]
        return self.spark.read.schema(ddl).option("basePath", root).parquet(*paths)

    def _load(self, live: dict[str, int]) -> DataFrame:
        return self.versioned(live).drop("version")
