"""Late trades set aside and counted, where an aggregation would drop them unseen.

A query ahead of the minute aggregation splits each micro-batch by the watermark that the aggregation will have:
the newest trade of all batches before, less the allowance. Both halves and the counts are taken in one pass.

    root/epoch=<n>/route=kept    topic records that count; the minute stream reads these
    root/epoch=<n>/route=late    topic records whose window had closed, with their time and the watermark
    root/epoch=<n>/route=unread  records that are no usable trades
    root/ledger/<n>.json         counts, newest trade and watermark of the batch

A batch that is repeated reads the ledger entry before its own, so it splits the same way and replaces its files. Where
the minute stream may have read them already, let trades carry ids and start that stream with `once`.
"""

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapemill.functions import event_time
from tapemill.operators.trades import decode_records
from tapemill.schemas import TOPIC_SCHEMA
from tapemill.sinks.files import Folder

# Fixed values, in ms: lateness allowance and window width, as in the minute stream.
ALLOWANCE_MS = 120_000
WIDTH_MS = 60_000
LATE_SCHEMA = "key binary, value binary, ts bigint, watermark_ms bigint, epoch bigint, route string"
LEDGER_SCHEMA = "epoch bigint, kept bigint, late bigint, unread bigint, newest_ms bigint, watermark_ms bigint"


def routed(messages: DataFrame, watermark_ms: int | None, width_ms: int = WIDTH_MS) -> DataFrame:
    """Topic records with their trade's time and route. A window that ends at or before the watermark is closed."""
    end = F.col("ts") - F.pmod("ts", F.lit(width_ms)) + width_ms
    closed = F.lit(False) if watermark_ms is None else end <= watermark_ms
    route = F.when(~F.col("usable"), "unread").when(closed, "late").otherwise("kept")
    time = F.when(F.col("usable"), F.col("ts"))
    return decode_records(messages).select(
        F.col("symbol").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        time.alias("ts"),
        F.lit(watermark_ms).cast("bigint").alias("watermark_ms"),
        route.alias("route"),
    )


def _entry(epoch: int) -> str:
    return f"{epoch:012d}.json"


def _watermark(ledger: Folder, epoch: int, allowance_ms: int) -> int | None:
    """The watermark of a batch, from the ledger entry of the one before."""
    earlier = [name for name in ledger.glob("*.json") if name < _entry(epoch)]
    if not earlier:
        return None
    last = json.loads(ledger.read_text(earlier[-1]))
    known = [last["watermark_ms"], last["newest_ms"] - allowance_ms if last["newest_ms"] is not None else None]
    return max((ms for ms in known if ms is not None), default=None)


def start_late_route(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    allowance_ms: int = ALLOWANCE_MS,
    width_ms: int = WIDTH_MS,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Split a stream of topic records under `root`; see the module's notes."""
    spark = messages.sparkSession
    folder, ledger = Folder(spark, root), Folder(spark, f"{root.rstrip('/')}/ledger")

    def write(batch: DataFrame, epoch: int) -> None:
        limit = _watermark(ledger, epoch, allowance_ms)
        seen = Observation()
        counts = [F.count_if(F.col("route") == name).alias(name) for name in ("kept", "late", "unread")]
        observed = routed(batch, limit, width_ms).observe(seen, *counts, F.max("ts").alias("newest_ms"))
        observed.write.mode("overwrite").partitionBy("route").parquet(folder.path(f"epoch={epoch:012d}"))
        ledger.replace_text(json.dumps({"epoch": epoch, **seen.get, "watermark_ms": limit}), _entry(epoch))

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def kept_records(spark: SparkSession, root: str) -> DataFrame:
    """Stream of the records that count, for `start_minute_stream`; a replaced file may be gone when it is read."""
    reader = spark.readStream.schema(TOPIC_SCHEMA).option("ignoreMissingFiles", "true")
    return reader.parquet(f"{root.rstrip('/')}/epoch=*/route=kept")


def late_records(spark: SparkSession, root: str) -> DataFrame:
    """Every late record with its time and the watermark that it met."""
    rows = spark.createDataFrame([], LATE_SCHEMA)
    if Folder(spark, root).glob("epoch=*"):
        rows = spark.read.schema(LATE_SCHEMA).option("basePath", root).parquet(f"{root.rstrip('/')}/epoch=*")
    late = rows.where(F.col("route") == "late")
    return late.select("epoch", "key", "value", event_time(F.col("ts")).alias("event_time"), "watermark_ms")


def route_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Counts of each batch by route, its newest trade and its watermark."""
    if not Folder(spark, root).glob("ledger"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(f"{root.rstrip('/')}/ledger")
