"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    A machine-local folder is used only by a local master, where it is shared by
    definition.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="eventmart-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when the statement that made them ends. Else they lie on the executors' disks until the driver collects its garbage,
#: which a long ingest may not see for many batches. It is for statements whose frames aren't run a second time.
PROMPT_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Plan the enclosed actions with other session settings, then put the old ones back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
