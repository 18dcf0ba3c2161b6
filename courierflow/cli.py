"""Command line: ``python -m courierflow.cli ingest|health|ddl|compact``.

Connection settings come from the environment: KAFKA_BOOTSTRAP_SERVERS,
KAFKA_SECURITY_PROTOCOL, KAFKA_SASL_MECHANISM, KAFKA_API_KEY, KAFKA_API_SECRET.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from dataclasses import replace
from datetime import date

from pyspark.sql import SparkSession

from courierflow.plans import health
from courierflow.schemas import MALFORMED_TABLE, TOPICS, Topic, all_tables_sql, table_schema, topic_for
from courierflow.session import prepare
from courierflow.sinks.upkeep import compact_closed, read_landed
from courierflow.sources.kafka import KafkaConnection, read_topics
from courierflow.streaming.ingest import start_topic
from courierflow.streaming.monitor import QueryMonitor
from courierflow.streaming.supervisor import Supervisor


log = logging.getLogger("courierflow.cli")


def connection() -> KafkaConnection:
    env = os.environ.get
    return KafkaConnection(
        env("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"),
        env("KAFKA_SECURITY_PROTOCOL", "PLAINTEXT"),
        env("KAFKA_SASL_MECHANISM", ""),
        env("KAFKA_API_KEY", ""),
        env("KAFKA_API_SECRET", ""),
    )


def settings(topic: Topic, args: argparse.Namespace) -> Topic:
    """The topic with what the command line says instead of its own settings."""
    given = {name: getattr(args, name) for name in ("trigger_seconds", "max_offsets", "starting_offsets")}
    return replace(topic, **{name: value for name, value in given.items() if value is not None})


def ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    topics = list(TOPICS.values()) if args.topic_key == "all" else [topic_for(args.topic_key)]
    conn, monitor = connection(), QueryMonitor()
    spark.streams.addListener(monitor)

    def starter(topic):
        records = lambda: read_topics(spark, conn, topic, min_partitions=args.min_partitions)
        return lambda: start_topic(records(), args.root, args.checkpoints, topic, files=args.files, table_format=args.table_format)

    supervisor = Supervisor({t.key: starter(settings(t, args)) for t in topics})
    supervisor.start()
    try:
        outcomes = supervisor.run()
    finally:
        for name, gauge in monitor.gauges.items():
            log.info("%s: %d batches, %d rows, %d late, error %s", name, gauge.batches, gauge.rows, gauge.late_rows, gauge.error)
    return int(any(o.state == "failed" for o in outcomes.values()))


def report(spark: SparkSession, args: argparse.Namespace) -> int:
    tables = {t.key: read_landed(spark, f"{args.root}/{t.table}", table_schema(t.key)) for t in TOPICS.values()}
    rows = health.health_report(tables).cache()
    rows.show(truncate=False)
    quarantine = read_landed(spark, f"{args.root}/{MALFORMED_TABLE}", table_schema(MALFORMED_TABLE))
    health.malformed_by_reason(quarantine).show(truncate=False)
    if health.is_empty_everywhere(rows):
        print("no rows in any table. Are events produced? Do the streams run? Do topic names match?", file=sys.stderr)
        return 1
    return 0


def ddl(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{args.database}`")
    for statement in all_tables_sql(args.root, args.database):
        print(statement, end=";\n\n")
        if not args.dry_run:
            spark.sql(statement)
    return 0


def compact(spark: SparkSession, args: argparse.Namespace) -> int:
    places = [(t.table, ("ingest_date",)) for t in TOPICS.values()] + [(MALFORMED_TABLE, ("ingest_date", "source_topic_key"))]
    for table, partition_by in places:
        merged = compact_closed(spark, f"{args.root}/{table}", args.before, partition_by, remove=not args.keep)
        log.info("%s: %d folders merged", table, merged)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, run, text in (
        ("ingest", ingest, "stream topics into the tables below --root"),
        ("health", report, "row counts, freshness and quarantine per table"),
        ("ddl", ddl, "create the external tables"),
        ("compact", compact, "merge the batch folders of closed dates"),
    ):
        sub = commands.add_parser(name, help=text)
        sub.set_defaults(run=run)
        sub.add_argument("--root", required=True, help="folder of the tables")
        if name == "ingest":
            sub.add_argument("--topic-key", required=True, choices=[*TOPICS, "all"])
            sub.add_argument("--checkpoints", required=True, help="folder of the stream checkpoints")
            sub.add_argument("--trigger-seconds", type=int, help="seconds between batches")
            sub.add_argument("--max-offsets", type=int, help="records of a batch at most")
            sub.add_argument("--starting-offsets", help="where a new checkpoint starts: earliest, latest or JSON")
            sub.add_argument("--min-partitions", type=int, help="input splits of a batch at least")
            sub.add_argument("--files", type=int, help="files of a batch at most")
            sub.add_argument("--table-format", help="a transactional format instead of replay-safe parquet folders")
        if name == "compact":
            sub.add_argument("--before", type=date.fromisoformat, default=date.today(), help="dates before this one are closed (default: today)")
            sub.add_argument("--keep", action="store_true", help="leave replaced folders for readers that listed them")
        if name == "ddl":
            sub.add_argument("--database")
            sub.add_argument("--dry-run", action="store_true")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    return args.run(prepare(SparkSession.builder.appName("courierflow").getOrCreate()), args)


if __name__ == "__main__":
    sys.exit(main())
