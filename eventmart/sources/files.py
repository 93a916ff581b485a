"""CSV and parquet scans."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators import storage


def file_place() -> list[Column]:
    """File and start of the split within the file, for rows read from files."""
    return [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
    ]


def arrival_order() -> list[Column]:
    """Arrival order of rows read from files: place, then a running number in the task.

    Take it directly on the scan: the number means nothing after a shuffle.
    """
    return [*file_place(), F.monotonically_increasing_id().alias("source_row")]


def csv_scan_raw(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Positional CSV scan into the fourteen text columns; the header line is skipped.

    Empty fields are NULL. A line with another number of fields is kept whole in
    ``malformed_line``, which is NULL for all others. ``multi_line`` is needed only for quoted line breaks; it
    makes every file one task, so it is off by default.
    """
    rows = (
        spark.read.schema(T.StructType([*schemas.RAW_SCHEMA.fields, T.StructField("malformed_line", T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "malformed_line")
        .option("columnPruning", False)  # a pruned parse doesn't see how many fields a line has
        .option("header", True)
        .option("enforceSchema", True)
        .option("nullValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return rows.select(*schemas.RAW_COLUMNS, "malformed_line", *arrival_order())


def csv_scan_by_name(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """CSV scan by header name: any column order, all text, missing columns NULL.

    Every file has its own header. Files are listed and their first lines read; those
    with the same header make one scan. Compressed files are read like others. A file without any of the fourteen
    names in its first line is an error: it would give rows of NULLs.
    """
    reader = spark.read.option("header", True).option("nullValue", "").option("quote", '"').option("escape", '"')
    reader = reader.option("enforceSchema", True).option("multiLine", multi_line)
    by_header: dict[str, list[str]] = {}
    for file in storage.files(spark, path):
        by_header.setdefault(storage.first_line(spark, file), []).append(file)
    out = None
    for line, files in by_header.items():
        header = next(csv.reader([line]), [])
        if line and not set(header) & set(schemas.RAW_COLUMNS):
            raise ValueError(f"no known column in the header of {files[0]}: {line[:200]!r}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        columns = [F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in schemas.RAW_COLUMNS]
        rows = reader.schema(schema).csv(files).select(*columns, *arrival_order())
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"no CSV file at {path}")
    return out


def csv_write(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write raw rows as CSV with a header; NULL as an empty field, blanks kept."""
    (
        df.write.option("header", True)
        .option("compression", compression)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
