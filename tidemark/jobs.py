"""One job of one day from the command line, for spark-submit and any orchestrator.

    spark-submit --py-files tidemark.zip tidemark/jobs.py combine --lake s3a://lake --start 2026-10-07

or ``python -m tidemark.jobs`` where the package is installed.

The run's day is the UTC day its data interval starts on. Order and retries belong to the
orchestrator; every job can be run again.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import day_text, run_day
from tidemark.plans import daily, ingest
from tidemark.session import build_session
from tidemark.sources import documents
from tidemark.sources.lake import Lake
from tidemark.streaming import drain, live


def interval_start(text: str) -> datetime:
    """An ISO instant in UTC; without an offset it is taken as UTC."""
    moment = datetime.fromisoformat(text)
    return moment.astimezone(timezone.utc) if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def input_messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The topic's messages, or landed message files."""
    if args.servers:
        return drain.topic_messages(spark, args.servers, args.topic, args.max_per_batch)
    return drain.file_messages(spark, args.input)


def drain_topic(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    """Empty the topic (or landed message files) into the lake, then require the run's day."""
    print(drain.drained(spark, input_messages(spark, args), lake.path("raw", "Edits"), lake.path("state", "edits-drain")))
    drain.require_day(spark, lake, day_text(args.day))


def live_hours(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> str:
    """Hourly counts of the hours closed so far, from the same messages."""
    target = lake.path("live", "HourlyEdits")
    live.land_live_hours(input_messages(spark, args), target, lake.path("state", "live-hours")).awaitTermination()
    return target


def send(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> dict[str, int]:
    """The run day's documents to files of a mounted folder, one sub-folder per index."""
    daily_indexes = [index for index, spec in documents.TABLES.items() if not spec.event_day]
    return {
        index: documents.send_day(spark, lake, index, day_text(args.day), documents.FolderWriter(f"{args.target}/{index}"))
        for index in daily_indexes
    }


PUBLISHED = [spec.table for spec in documents.TABLES.values()]
JOBS = {
    "drain-edits": drain_topic,
    "format-edits": lambda s, lake, a: ingest.format_edits(s, lake, a.day),
    "format-hourly-views": lambda s, lake, a: ingest.format_hourly_views(s, lake, a.input, a.day),
    "format-hourly-tsv": lambda s, lake, a: ingest.format_hourly_tsv(s, lake, a.input, a.day),
    "format-daily-top": lambda s, lake, a: ingest.format_daily_top(s, lake, a.input, a.day),
    "plan-entity-requests": lambda s, lake, a: ingest.plan_entity_requests(s, lake, a.day),
    "format-entities": lambda s, lake, a: ingest.format_entities(s, lake, a.input, a.day),
    "combine": lambda s, lake, a: daily.combine_day(s, lake, a.day),
    "combine-days": lambda s, lake, a: daily.combine_period(s, lake, a.day, a.last),
    "sweep": lambda s, lake, a: [f for table in PUBLISHED for f in lake.sweep(s, "usage", table)],
    "leadlag": lambda s, lake, a: daily.leadlag_day(s, lake, a.day),
    "publish": lambda s, lake, a: daily.publish_day(s, lake, a.day),
    "send": send,
    "live-hours": live_hours,
    "publish-leadlag": lambda s, lake, a: daily.publish_leadlag(s, lake, a.day),
}
NEED_MESSAGES = {"drain-edits", "live-hours"}
NEED_INPUT = {"format-hourly-views", "format-hourly-tsv", "format-daily-top", "format-entities"}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--start", required=True, type=interval_start, help="start of the data interval")
    parser.add_argument("--end", type=interval_start, help="last day of combine-days; the start's day without it")
    parser.add_argument("--input", help="landed files: dumps, top lists, responses or messages")
    parser.add_argument("--target", help="mounted folder that send writes to")
    parser.add_argument("--servers", help="brokers of the topic; landed message files are read without")
    parser.add_argument("--topic", default=drain.TOPIC)
    parser.add_argument("--max-per-batch", type=int, help="messages per batch while draining")
    args = parser.parse_args(argv)
    if args.job in NEED_INPUT and not args.input:
        parser.error(f"{args.job} needs --input")
    if args.job in NEED_MESSAGES and not (args.servers or args.input):
        parser.error(f"{args.job} needs --servers or --input")
    if args.job == "send" and not args.target:
        parser.error("send needs --target")
    args.day = run_day(args.start)
    args.last = run_day(args.end) if args.end else args.day
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    session = spark or build_session(f"tidemark-{args.job}")
    result = JOBS[args.job](session, Lake(args.lake), args)
    if result is not None:
        print(result)


if __name__ == "__main__":
    main()
