"""Small helpers of the operators: staged tables, size-checked joins, text slices."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.session import fresh_path

#: A side of a join is broadcast up to so many narrow rows; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: And of so many bytes, a field counting as the least that a hash table takes for it beside its text.
BROADCAST_BYTES, FIELD_BYTES = 96 << 20, 16
#: Characters of text handled at a time inside a task.
SLICE_CHARS = 2_000_000


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is proven small, in rows and in bytes; ``rows`` if already counted."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType | T.BinaryType)]
    chars = 0
    if rows is None or texts:
        sizes = [F.coalesce(F.sum(F.octet_length(f"`{c}`").cast("long")), F.lit(0)) for c in texts]
        rows, *sizes = df.agg(F.count("*"), *sizes).first()
        chars = sum(sizes)
    narrow = rows <= BROADCAST_ROWS and chars + FIELD_BYTES * rows * len(df.columns) <= BROADCAST_BYTES
    return F.broadcast(df) if narrow else df


#: Bytes of an Arrow batch: what a Python worker holds of its input at a time.
BATCH_BYTES = 8 << 20
ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Bound the batches of the Python workers, and make the package importable for them, if it isn't on their path already.

    Jobs that are submitted with it (--py-files, an installed wheel) have it there.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    paths = {Path(p).resolve() for p in [".", *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    context = spark.sparkContext
    if ROOT in paths or "site-packages" in ROOT.parts or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp()) / "eventmart.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for f in sorted((ROOT / "eventmart").rglob("*.py")):
            out.write(f, f.relative_to(ROOT))
    context.addPyFile(str(archive))  # served to the executors by the driver
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return a worker's freed memory to the system: workers stay, and hold on to what they have freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # only the GNU C library has it
        return


def lean(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task of ``mapInArrow`` that gives its memory back when it ends."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch], *args) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches, *args)
        finally:
            give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session is sized."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts together stay near ``limit`` bytes; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)
