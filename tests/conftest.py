from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eventmart import schemas  # noqa: E402
from eventmart.session import configure  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return configure(session)


GOOD = {
    "event_id": "00000001-abcd-4000-8000-000000000001",
    "event_timestamp": "2024-10-01 10:00:00",
    "entity_id": "7",
    "zone_id": "3",
    "destination_id": "4",
    "vendor_id": "1",
    "event_type": "standard",
    "rate_type": "1",
    "duration": "60",
    "passenger_count": "1.0",
    "value": "10.00",
    "sub_value": "1.00",
    "total_value": "11.00",
    "payment_method": "card",
}


def uuid_of(n: int) -> str:
    return str(uuid.UUID(int=n + (4 << 76) + (8 << 60)))


def row(n: int, **changes) -> dict:
    return GOOD | {"event_id": uuid_of(n)} | changes


@pytest.fixture
def raw_rows(spark):
    """Raw rows in arrival order."""

    def make(rows: list[dict], source: str = "a"):
        data = [tuple(r[c] for c in schemas.RAW_COLUMNS) + (source, 0, i) for i, r in enumerate(rows)]
        fields = ", ".join(f"{c} string" for c in [*schemas.RAW_COLUMNS, "source_file"])
        return spark.createDataFrame(data, f"{fields}, source_block long, source_row long")

    return make


@pytest.fixture
def evaluate(spark):
    """Values of an expression over text inputs."""

    def run(texts: list[str | None], expression, to: str = "string") -> list:
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r.x for r in df.select("i", expression(F.col("t")).cast(to).alias("x")).orderBy("i").collect()]

    return run
