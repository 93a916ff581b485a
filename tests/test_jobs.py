"""The jobs, end to end on one warehouse folder."""

from __future__ import annotations

from conftest import SF_DIR

from eventmart import jobs
from eventmart.plans.mart import Mart
from eventmart.session import fresh_path
from eventmart.sources import files
from eventmart.streaming import ingest
from parity import fixture


def test_all_jobs(spark, capsys):
    root, csv, topic = (fresh_path(spark, n) for n in ("mart", "csv", "messages"))
    files.csv_write(fixture.raw_events(spark, SF_DIR).select(*fixture.schemas.RAW_COLUMNS), csv)

    def job(*argv: str) -> int:
        return jobs.run(spark, jobs.parse_args(list(argv)))

    assert job("load", "--root", root, "--csv", csv) == 0
    assert job("publish", "--csv", csv, "--messages", topic) == 0
    assert job("ingest", "--root", root, "--checkpoint", fresh_path(spark, "cp"), "--messages", topic) == 0
    assert ingest.stream_events(spark, root).count() == 989
    assert job("queries", "--root", root) == 0
    out = fresh_path(spark, "out")
    assert job("unify", "--root", root, "--sweep", "--out", out) == 0
    ids = spark.read.parquet(f"{out}/unified_events").select("event_id")
    assert ids.count() == ids.distinct().count() >= 989
    assert job("health", "--root", root) == 1  # too few rows, unresolved names, new vendors
    assert "dominant_payment" in capsys.readouterr().out
    assert job("retire", "--root", root, "--before", "2024-02-01", "--archive", fresh_path(spark, "archive")) == 0
    mart = Mart(spark, root)
    assert mart.months() == ["2024-02-01", "2024-03-01"]
    report = {r.check: r.status for r in jobs.health(mart, minimum=100).collect()}
    assert report["rows streaming_events"] == "ok" and report["table streaming_events"] == "ok"
