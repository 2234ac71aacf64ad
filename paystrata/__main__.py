"""Command line: one table, one day, one streaming job, or one serving query.

    python -m paystrata table dws_merchant_daily 2026-09-04 --lake /data/lake --sources /data/raw
    python -m paystrata day 2026-09-04 --lake /data/lake --sources /data/raw
    python -m paystrata stream clean --lake /data/lake --topics /data/topics
    python -m paystrata stream windows --lake /data/lake --kafka broker:9092
    python -m paystrata recent --lake /data/lake --customer C17 --limit 20
    python -m paystrata profile C17 --lake /data/lake
    python -m paystrata compact --lake /data/lake
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from paystrata.model import (
    LATE_KEY, LATE_TRANSACTION, ONLINE_KEY, REALTIME_AGG, TABLES, TRANSACTION_ONLINE, WINDOW_KEY,
)
from paystrata.operators import serving
from paystrata.plans.tables import Warehouse, run_day, run_table
from paystrata.session import build_session
from paystrata.sources.keyed import KeyedLog
from paystrata.sources.lake import Lake
from paystrata.sources.topics import folder_topic, kafka_topic, parse_messages, write_folder, write_kafka
from paystrata.streaming import jobs
from paystrata.streaming.newest import TTL_SECONDS

RAW, CLEANED = "transaction", "dwd_transaction"
MOST_RECENT = 10_000


def _logs(spark, lake: str) -> list[KeyedLog]:
    keyed = f"{lake}/keyed"
    return [_online(spark, lake), KeyedLog(spark, f"{keyed}/late_transaction", LATE_TRANSACTION, LATE_KEY),
            KeyedLog(spark, f"{keyed}/dws_realtime_agg", REALTIME_AGG, WINDOW_KEY, "customer_id")]


def _topic(spark, args, name: str):
    if args.kafka:
        return kafka_topic(spark, args.kafka, name, f"{name}-group", maxOffsetsPerTrigger=str(args.most_messages))
    return folder_topic(spark, f"{args.topics}/{name}", maxFilesPerTrigger=str(args.most_files))


def _publisher(args):
    if args.kafka:
        return lambda messages, batch_id: write_kafka(messages, args.kafka, CLEANED)
    return lambda messages, batch_id: write_folder(messages, f"{args.topics}/{CLEANED}", batch_id)


def _online(spark, lake: str) -> KeyedLog:
    return KeyedLog(spark, f"{lake}/keyed/dwd_transaction_online", TRANSACTION_ONLINE, ONLINE_KEY, "customer_id")


def serve(spark, args) -> list[str]:
    """The answer as JSON lines: at most ``limit`` transactions, or one customer."""
    log = _online(spark, args.lake)
    if args.command == "recent":
        if not 1 <= args.limit <= MOST_RECENT:
            raise ValueError(f"limit must be from 1 to {MOST_RECENT}")
        of_customer = None if args.customer is None else F.col("customer_id") == args.customer
        newest = log.newest("event_time", args.limit, of_customer)
        columns = newest.columns if args.all_columns else None
        return serving.recent_transactions(newest, args.customer, args.limit, columns).toJSON().collect()
    online = log.latest()
    profiles = Lake(spark, args.lake).read("ads_customer_profile")
    return serving.full_profile(online, profiles, args.customer).toJSON().collect()


def start_stream(spark, args):
    keyed, checkpoint = f"{args.lake}/keyed", f"{args.lake}/checkpoints/{args.job}"
    trigger = jobs.BACKLOG if args.backlog else jobs.EVERY
    if args.job == "clean":
        late = KeyedLog(spark, f"{keyed}/late_transaction", LATE_TRANSACTION, LATE_KEY)
        return jobs.start_clean_job(_topic(spark, args, RAW), Lake(spark, args.lake), _online(spark, args.lake), late,
                                    _publisher(args), checkpoint, trigger, args.ttl)
    sink = KeyedLog(spark, f"{keyed}/dws_realtime_agg", REALTIME_AGG, WINDOW_KEY, "customer_id")
    return jobs.start_window_job(parse_messages(_topic(spark, args, CLEANED), TRANSACTION_ONLINE), sink, checkpoint,
                                 trigger, dedup=args.dedup)


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="paystrata")
    commands = main.add_subparsers(dest="command", required=True)
    table = commands.add_parser("table")
    table.add_argument("name")
    table.add_argument("day", nargs="?")
    day = commands.add_parser("day")
    day.add_argument("day")
    for batch in (table, day):
        batch.add_argument("--sources", required=True, help="folder with master/ and transaction/")
    stream = commands.add_parser("stream")
    stream.add_argument("job", choices=["clean", "windows"])
    where = stream.add_mutually_exclusive_group(required=True)
    where.add_argument("--topics", help="folder of message files")
    where.add_argument("--kafka", help="bootstrap servers")
    stream.add_argument("--most-messages", type=int, default=1_000_000, help="bound of a micro-batch from Kafka")
    stream.add_argument("--most-files", type=int, default=1_000, help="bound of a micro-batch from a folder")
    stream.add_argument("--ttl", type=int, default=TTL_SECONDS,
                        help="clean: seconds of event time after which the newest row of a transaction is forgotten")
    stream.add_argument("--dedup", action="store_true", help="windows: count a repeated row once")
    stream.add_argument("--backlog", action="store_true", help="work off what is there and stop")
    recent = commands.add_parser("recent")
    recent.add_argument("--customer")
    recent.add_argument("--limit", type=int, default=20)
    recent.add_argument("--all-columns", action="store_true", help="with the enriched attributes")
    profile = commands.add_parser("profile")
    profile.add_argument("customer")
    compact = commands.add_parser("compact", help="fold the keyed logs and drop old versions of all tables")
    compact.add_argument("--grace", type=float, default=86_400, help="seconds that unused folders stay")
    for command in (table, day, stream, recent, profile, compact):
        command.add_argument("--lake", required=True)
    return main


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"paystrata-{args.command}")
    if args.command == "stream":
        start_stream(spark, args).awaitTermination()
        return
    if args.command == "compact":
        for log in _logs(spark, args.lake):
            log.compact()
        lake = Lake(spark, args.lake)
        for name in TABLES:
            lake.drop_old_versions(name, grace_seconds=args.grace)
        return
    if args.command in ("recent", "profile"):
        print("\n".join(serve(spark, args)))
        return
    house = Warehouse(Lake(spark, args.lake), {b: f"{args.sources}/{b}" for b in ("master", "transaction")})
    if args.command == "table":
        print(json.dumps(run_table(house, args.name, args.day)))
    else:
        print(json.dumps(run_day(house, args.day)))


if __name__ == "__main__":
    main()
