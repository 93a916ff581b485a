"""Path helpers on whatever file system the cluster uses."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventmart import schemas


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.rename(p, _fs(spark, to)[1]):
        raise OSError(f"cannot move {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small marker file; False when it is already there."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    out = fs.create(p, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small marker file."""
    return "\n".join(r.value for r in spark.read.text(path).collect())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (none when it does not exist)."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a data file; marker files, which are optional, tell nothing."""
    return any(not name.startswith(("_", ".")) for name in children(spark, path))


def files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Data files below paths, which may be folders, files or globs, in order of their names."""
    out = []
    for pattern in [path] if isinstance(path, str) else path:
        fs, p = _fs(spark, pattern)
        todo = [s for s in fs.globStatus(p) or []]
        while todo:
            status = todo.pop()
            if status.isDirectory():
                todo += [s for s in fs.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
            else:
                out.append(status.getPath().toString())
    return sorted(out)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, without its line end and byte order mark; compressed files are known by their names."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p) if codec is None else codec.createInputStream(fs.open(p))
    source = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return (source.readLine() or "").lstrip("\ufeff")
    finally:
        source.close()


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``; an empty DataFrame while nothing has been written there."""
    try:
        return spark.read.schema(schemas.nullable(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.nullable(schema))


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file in one step: readers see all of it or nothing. Fails when it is there."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    attempt = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    write_text(spark, attempt, text)
    if not fs.rename(_fs(spark, attempt)[1], p):
        raise FileExistsError(path)


def content(spark: SparkSession, path: str) -> str:
    """Content of a small file, read without a job."""
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
