"""The jobs of a warehouse folder: load, publish, ingest, compact, revenue, queries, health, retire.

    python -m eventmart.jobs load --root hdfs:///mart --csv hdfs:///in/*.csv
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from eventmart import schemas
from eventmart.operators import storage
from eventmart.plans import analytics, quality
from eventmart.plans.mart import Mart
from eventmart.plans.unify import UnifiedTable
from eventmart.session import configure
from eventmart.sources import files, messages
from eventmart.streaming import aggregates, compaction, ingest

log = logging.getLogger("eventmart")
SINKS = {"events": ingest.Ingest, "revenue": aggregates.RevenueSink, "dual": aggregates.DualSink}


def health(mart: Mart, minimum: int):
    """Health report of a warehouse folder, its stream table included when there is one."""
    spark = mart.spark
    stream = None
    if storage.exists(spark, mart.path("streaming_events")):
        stream = ingest.stream_events(spark, mart.root)
    dims = {n: mart.dim(n) for n in schemas.EXPECTED_DIM_ROWS}
    return quality.health_report(
        spark, mart.present_tables(), mart.raw(), mart.fact(), dims, mart.dim("dim_zone"), stream, minimum
    )


def message_source(spark: SparkSession, args: argparse.Namespace):
    if args.messages:
        return messages.file_stream(spark, args.messages, args.batch_size)
    return messages.kafka_stream(spark, args.topic, args.bootstrap, args.batch_size)


def parse_args(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventmart")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        for o in options:
            p.add_argument(f"--{o}", required=True)
        return p

    p = job("load", "root", "csv")
    p.add_argument("--buckets", type=int)
    p.add_argument("--on-bad", choices=["quarantine", "fail"], default="quarantine")
    p.add_argument("--load-id", help="folder of the rejects; default: a name of the source files")
    p.add_argument("--scope", choices=["all", "month"], default="all")
    p = job("publish", "csv")
    p.add_argument("--messages", help="folder of message files; without it Kafka is used")
    p.add_argument("--topic", default="events")
    p.add_argument("--bootstrap", default="localhost:9092")
    p = job("ingest", "root", "checkpoint")
    p.add_argument("--messages", help="folder of message files; without it Kafka is used")
    p.add_argument("--topic", default="events")
    p.add_argument("--bootstrap", default="localhost:9092")
    p.add_argument("--batch-size", type=int, help="offsets (or files) per micro-batch")
    p.add_argument("--dedup", choices=["table", "state"], default="table")
    p.add_argument("--interval", help="'10 seconds'; without it the job drains the source and stops")
    p.add_argument("--sink", choices=sorted(SINKS), default="events", help="what is kept beside the events")
    p = job("compact", "root")
    p.add_argument("--sweep", action="store_true", help="delete what was replaced; no reader may use an older version")
    p = job("unify", "root")
    p.add_argument("--sweep", action="store_true", help="delete what was replaced; no reader may use an older version")
    p.add_argument("--out", help="folder for all events, as parquet")
    p = job("revenue", "root")
    p.add_argument("--out", help="folder for the whole result, as parquet")
    p = job("queries", "root")
    p.add_argument("--out", help="folder for the whole results, as parquet; without it their first rows are shown")
    p = job("health", "root")
    p.add_argument("--out", help="folder for the whole report, as parquet")
    p.add_argument("--minimum", type=int, default=schemas.EXPECTED_MIN_ROWS)
    job("retire", "root", "before", "archive")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one job; the exit code is 1 when a health check found issues."""
    configure(spark)
    if args.job == "load":
        mart = Mart(spark, args.root, args.buckets)
        scan = files.csv_scan_raw(spark, args.csv)
        mart.load_batch(scan, args.on_bad, args.load_id, args.scope).show(truncate=False)
    elif args.job == "publish":
        rows = files.csv_scan_by_name(spark, args.csv)
        if args.messages:
            messages.publish_files(rows, args.messages)
        else:
            messages.publish_kafka(rows, args.topic, args.bootstrap)
    elif args.job == "ingest":
        source = message_source(spark, args)
        ingest.drain(ingest.start_ingest(source, args.root, args.checkpoint, args.dedup, args.interval, SINKS[args.sink]))
        ingest.metrics_totals(ingest.stream_metrics(spark, args.root)).show()
    elif args.job == "compact":
        table = compaction.Compaction(spark, args.root)
        log.info("merged: %s, deleted: %s", table.compact(), table.sweep() if args.sweep else 0)
    elif args.job == "unify":
        unified = UnifiedTable(Mart(spark, args.root))
        log.info("buckets written again: %s, deleted: %s", unified.merge(), unified.sweep() if args.sweep else 0)
        if args.out:
            unified.events().write.mode("overwrite").parquet(f"{args.out}/unified_events")
    elif args.job == "revenue":
        sums = aggregates.revenue(spark, args.root)
        if args.out:
            sums.write.mode("overwrite").parquet(f"{args.out}/stream_revenue")
        else:
            sums.orderBy("window_start", "event_type").show(truncate=False)
    elif args.job == "queries":
        mart = Mart(spark, args.root)
        results = {
            "q1_monthly_revenue": analytics.q1_monthly_revenue(mart.fact(), types=mart.dim("dim_event_type")),
            "q2_top_entities": analytics.q2_top_entities(mart.fact(), methods=mart.dim("dim_payment_method")),
            "daily_rollup": mart.summaries.daily_rollup(mart.dim("dim_event_type")),
            "entity_metrics": mart.summaries.entity_metrics(),
        }
        for name, df in results.items():
            if args.out:
                df.write.mode("overwrite").parquet(f"{args.out}/{name}")
            else:
                df.show(truncate=False)
    elif args.job == "health":
        report = health(Mart(spark, args.root), args.minimum)
        if args.out:
            report.write.mode("overwrite").parquet(f"{args.out}/health_report")
        report.show(1000, truncate=False)
        return quality.dq_summary(report).first().exit_code
    elif args.job == "retire":
        log.info("retired %s", Mart(spark, args.root).retire_months(args.before, args.archive))
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(run(SparkSession.builder.appName("eventmart").getOrCreate(), parse_args(sys.argv[1:])))
