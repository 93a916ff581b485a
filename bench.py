"""Benchmark: the batch pipeline step by step, the queries, and the stream.

Input is $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS]. Prints one JSON line;
``value`` is the sum of all steps. The CSV and message files are made beforehand
and a pass over sf0.001 warms the JVM up; neither is timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventmart.plans import analytics, quality  # noqa: E402
from eventmart.plans.mart import Mart  # noqa: E402
from eventmart.session import configure, fresh_path  # noqa: E402
from eventmart.sources import files, messages  # noqa: E402
from eventmart.streaming import ingest  # noqa: E402
from parity import fixture  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = str(Path(SF_DIR).parent / "sf0.001")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("eventmart-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def measure(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    seconds: dict[str, float] = {}

    def timed(name: str, step: Callable):
        start = time.perf_counter()
        out = step()
        seconds[name] = round(time.perf_counter() - start, 3)
        return out

    raw = fixture.raw_events(spark, sf_dir)
    csv, topic = fresh_path(spark, "csv"), fresh_path(spark, "messages")
    files.csv_write(raw.select(*fixture.schemas.RAW_COLUMNS), csv)
    messages.publish_files(raw.repartition(4, "event_id"), topic)

    mart = timed("create_schema", lambda: Mart(spark, fresh_path(spark, "mart")))
    scan = files.csv_scan_raw(spark, csv)
    staged = timed("ingest_to_staging", lambda: mart.stage_reload(scan))
    timed("transform_to_fact", lambda: mart.transform_staged(staged))
    timed("validate_and_log", lambda: quality.validate_load(staged, mart.fact()))
    timed("load_replay", lambda: mart.load_batch(scan))
    timed("q1_monthly_revenue", lambda: analytics.q1_monthly_revenue(mart.fact()).collect())
    timed("q2_top_entities", lambda: analytics.q2_top_entities(mart.fact()).collect())
    dims = {n: mart.dim(n) for n in ("dim_event_type", "dim_payment_method", "dim_vendor")}
    report = quality.health_report(
        spark, mart.present_tables(), mart.raw(), mart.fact(), dims, mart.dim("dim_zone")
    )
    timed("health_report", lambda: report.collect())

    for mode in ("table", "state"):
        target, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "checkpoint")
        stream = messages.file_stream(spark, topic, max_files=4)
        timed(
            f"stream_ingest_{mode}",
            lambda: ingest.drain(ingest.start_ingest(stream, target, checkpoint, mode)),
        )
    return seconds


def main() -> None:
    spark = session()
    measure(spark, WARM_UP)
    seconds = measure(spark, SF_DIR)
    line = {
        "metric": "batch load, replay, queries, health report and stream ingest",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "cpus": int(CPUS),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
