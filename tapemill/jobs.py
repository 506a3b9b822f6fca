"""Command line of the jobs, for spark-submit or `python -m tapemill.jobs`.

    route      trades of a topic split into those in time and late ones, with counts
    trades     exchange messages of one topic, normalised onto another; rejects to a folder
    minutes    trades of a topic (or of text files) into the minute table, continuously
    hourly     freshness gate, hour rollup, snapshot
    dashboard  prints the monitoring frames
"""

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from tapemill.operators.trades import classify_messages, trade_columns, unparsed_trades
from tapemill.plans import build_dashboard, run_hourly
from tapemill.session import build_session
from tapemill.sinks import BarTable, publish_trades
from tapemill.sources import read_trade_stream, read_trade_topic
from tapemill.streaming import kept_records, start_late_route, start_minute_stream


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if getattr(args, "routed", None):
        return kept_records(spark, args.routed)
    if args.files:
        return read_trade_stream(spark, "text", args.files)
    return read_trade_topic(spark, args.servers, args.topic, args.starting_offsets, args.min_partitions)


def trades(spark: SparkSession, args: argparse.Namespace) -> None:
    """One query over the classified messages feeds both the topic and the rejects, from one parse.

    A batch that fails half-way is published again. With `--ids` its trades carry ids, by which
    `minutes --once` counts each of them once.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            usable = batch.where("reason IS NULL").select(*trade_columns(batch))
            publish_trades(usable, args.servers, args.to_topic)
            if args.rejects:
                rejects = batch.where("reason IS NOT NULL").select("value", "reason")
                # A folder of its own for each batch, so that a repeated one replaces its rejects.
                rejects.write.mode("overwrite").json(f"{args.rejects}/batch={epoch}")
        finally:
            batch.unpersist()

    classified = classify_messages(_messages(spark, args), args.symbol, identified=args.ids)
    writer = classified.writeStream.option("checkpointLocation", f"{args.checkpoint}/trades")
    writer.foreachBatch(write).start().awaitTermination()


def route(spark: SparkSession, args: argparse.Namespace) -> None:
    query = start_late_route(
        _messages(spark, args),
        args.to,
        args.checkpoint,
        available_now=args.available_now,
        processing_time=args.every,
    )
    query.awaitTermination()


def minutes(spark: SparkSession, args: argparse.Namespace) -> None:
    table = BarTable(spark, args.table, args.partition_by)
    messages = _messages(spark, args)
    if args.rejects:
        rejects = unparsed_trades(messages).writeStream.format("json")
        rejects = rejects.option("checkpointLocation", f"{args.checkpoint}-rejects")
        if args.available_now:
            rejects = rejects.trigger(availableNow=True)
        elif args.every:
            rejects = rejects.trigger(processingTime=args.every)
        rejected = rejects.start(args.rejects)
    query = start_minute_stream(
        messages,
        lambda batch: table.upsert(batch, keyed=True),
        args.checkpoint,
        available_now=args.available_now,
        processing_time=args.every,
        state_partitions=args.state_partitions,
        once=args.once,
    )
    query.awaitTermination()
    if args.rejects:
        rejected.awaitTermination()


def hourly(spark: SparkSession, args: argparse.Namespace) -> None:
    by_minute = BarTable(spark, args.table, args.partition_by)
    _print_all(run_hourly(by_minute, BarTable(spark, args.hours), args.backups, args.now))


def dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    now = args.now or datetime.now(timezone.utc)
    bars = BarTable(spark, args.table, args.partition_by).read(since=now - timedelta(hours=1))
    for name, frame in build_dashboard(bars, now, args.symbol).items():
        print(name)
        _print_all(frame)


def _print_all(frame: DataFrame) -> None:
    """All rows, a partition at a time."""
    print(*frame.columns, sep="\t")
    for row in frame.toLocalIterator():
        print(*row, sep="\t")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tapemill", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, job, *groups: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(job=job)
        if "source" in groups:
            sub.add_argument("--servers", help="Kafka bootstrap servers")
            sub.add_argument("--topic")
            sub.add_argument("--starting-offsets", default="latest")
            sub.add_argument("--min-partitions", type=int)
            sub.add_argument("--files", help="folder of text files instead of a topic")
            sub.add_argument("--checkpoint", required=True)
        if "table" in groups:
            sub.add_argument("--table", required=True, help="folder of the minute table")
            sub.add_argument("--partition-by", choices=["day", "hour"], default="hour")
        if "clock" in groups:
            sub.add_argument("--now", type=datetime.fromisoformat, help="UTC unless it names a zone")
        return sub

    sub = command("trades", trades, "source")
    sub.add_argument("--to-topic", required=True)
    sub.add_argument("--symbol", help="overrides the symbol of the messages")
    sub.add_argument("--rejects", help="folder for messages that are not trades")
    sub.add_argument("--ids", action="store_true", help="publish each trade with an id")
    sub = command("route", route, "source")
    sub.add_argument("--to", required=True, help="folder of the split records")
    sub.add_argument("--available-now", action="store_true")
    sub.add_argument("--every", help='micro-batch interval, e.g. "10 seconds"')
    sub = command("minutes", minutes, "source", "table")
    sub.add_argument("--routed", help="folder that `route` writes, instead of a topic")
    sub.add_argument("--available-now", action="store_true")
    sub.add_argument("--state-partitions", type=int, help="fixed by the first start on a checkpoint")
    sub.add_argument("--once", action="store_true", help="count trades of one id once; fixed by the first start")
    sub.add_argument("--every", help='micro-batch interval, e.g. "10 seconds"')
    sub.add_argument("--rejects", help="folder for records that are no usable trades")
    sub = command("hourly", hourly, "table", "clock")
    sub.add_argument("--hours", required=True, help="folder of the hour table")
    sub.add_argument("--backups", required=True)
    sub = command("dashboard", dashboard, "table", "clock")
    sub.add_argument("--symbol")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.job(build_session(f"tapemill-{args.command}"), args)


if __name__ == "__main__":
    main()
