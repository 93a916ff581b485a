"""Operator 10: token counts by a scan for separators in flat, unindexed token files.

A flat file is nothing but unsigned little-endian ids, every document followed by the
end-of-document id. The scan cuts files into blocks of bytes, searches each block
with numpy, and stitches documents over block boundaries: a prefix scan over one
summary row per block tells how many documents ended before a block, and how many ids
were left open. A document of any length may span any number of blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.common import small, staged
from eventmart.llm.token_files import encoded, to_file, uri_of
from eventmart.session import fresh_path

#: Bytes of a block; a multiple of the id size.
BLOCK_BYTES = 4 << 20


def write_flat_files(docs: DataFrame, out: str, tokenizer: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Write ids of all texts, in the order in which the table is read, and return (file, ordinal, doc_id).

    Text never yields ``end_id``: its string in a text is encoded as ordinary text.
    Null texts are empty and take just the separator. Texts aren't shuffled. Every
    attempt of a task writes a file of its own, and the returned rows name those that count;
    of documents and where they end, the files hold no trace.
    """
    out = uri_of(out)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = encoded(batches, tokenizer, special_as_text=True)
        first = next(rows, None)
        if first is None:
            return
        uri, ids = f"{out}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.bin", []

        def fill(sink) -> None:
            found, end = first, int(end_id).to_bytes(4, "little")
            while found is not None:
                doc_ids, texts = found
                sink.write(np.frombuffer(b"".join(t + end for t in texts), "<u4").astype(dtype).tobytes())
                ids.extend(doc_ids)
                found = next(rows, None)

        to_file(uri, fill)
        for i in range(0, len(ids), 10_000):
            own = ids[i : i + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([uri] * len(own)), pa.array(range(i, i + len(own)), pa.int64()), pa.array(own, pa.int64())],
                ["file", "ordinal", "doc_id"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = rows.mapInArrow(write, "file string, ordinal long, doc_id long")
    return staged(order, "flat-order")


def _scan(batches: Iterator[pa.RecordBatch], end_id: int, dtype: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, block, begin, size in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            system, path = fs.FileSystem.from_uri(uri)
            with system.open_input_file(path) as source:
                ids = np.frombuffer(source.read_at(size, begin), dtype)
            at = np.flatnonzero(ids == end_id)
            lengths = np.diff(at, prepend=-1)
            # the last row of a block is what it leaves open; it is no document
            n = np.concatenate([lengths, [len(ids) - (at[-1] + 1 if len(at) else 0)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([uri] * len(n)), pa.array([block] * len(n), pa.int64()), pa.array(range(len(n)), pa.int64()), pa.array(n, pa.int64()), pa.array([False] * len(at) + [True])],
                ["file", "block", "k", "n", "is_open"],
            )


def scan_separators(spark: SparkSession, files: list[tuple[str, int]], end_id: int, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens) of every document of the files, given with their sizes.

    ``n_tokens`` counts the separator. ``start`` and ``ordinal`` count within the file.
    Ids after the last separator of a file are an unfinished document: n_tokens counts
    them, and ``complete`` is false.
    """
    if any(size % np.dtype(dtype).itemsize for _, size in files):
        raise ValueError("a file isn't a whole number of ids")
    lists = spark.createDataFrame(files, "file string, size long")
    blocks = lists.select("file", F.explode(F.sequence(F.lit(0), F.floor((F.greatest("size", F.lit(1)) - 1) / block_bytes))).alias("block"), "size")
    blocks = blocks.select("file", "block", (F.col("block") * block_bytes).alias("begin"), F.least(F.lit(block_bytes), F.col("size") - F.col("block") * block_bytes).alias("n"))
    blocks = blocks.repartition(max(1, sum(-(-size // block_bytes) for _, size in files)))
    found = staged(blocks.mapInArrow(lambda b: _scan(b, end_id, dtype), "file string, block long, k long, n long, is_open boolean"), "separators")

    # one row per block; the scan over them is by file
    sums = found.filter("is_open").select("file", "block", F.col("k").alias("docs"), F.col("n").alias("left"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("docs") > 0, F.col("block"))
    sums = sums.withColumn("ordinal0", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    # open ids since the last separator: those the block with it left, and all of later blocks
    sums = sums.withColumn("since", F.coalesce(F.max(ends).over(before), F.lit(-1)))
    run = Window.partitionBy("file", "since").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    tail = F.last(F.when(F.col("docs") > 0, F.col("left")), True).over(before)
    sums = sums.withColumn("carry", F.coalesce(tail, F.lit(0)) + F.coalesce(F.sum("left").over(run), F.lit(0)))
    sums = sums.select("file", "block", "ordinal0", "carry")
    sizes = found.groupBy("file", "block").agg(F.sum("n").alias("ids"))
    starts = sizes.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).select("file", "block", "base")
    sums = small(staged(sums.join(starts, ["file", "block"]), "blocks"))

    last = Window.partitionBy("file", "block").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    docs = found.withColumn("offset", F.coalesce(F.sum("n").over(last), F.lit(0))).join(sums, ["file", "block"])
    first = F.when(F.col("k") == 0, F.col("carry")).otherwise(0)
    docs = docs.select("file", "block", "is_open", (F.col("ordinal0") + F.col("k")).alias("ordinal"), (F.col("base") + F.col("offset") - first).alias("start"), (F.col("n") + first).alias("n_tokens"))
    final = Window.partitionBy("file")
    open_end = docs.filter("is_open").withColumn("end", F.max("block").over(final)).filter("block = end and n_tokens > 0")
    done = docs.filter("not is_open").select("file", "ordinal", "start", "n_tokens", F.lit(True).alias("complete"))
    return done.unionByName(open_end.select("file", "ordinal", "start", "n_tokens", F.lit(False).alias("complete")))


def flat_sizes(files: list[str]) -> list[tuple[str, int]]:
    """Files with their bytes."""
    out = []
    for uri in files:
        system, path = fs.FileSystem.from_uri(uri)
        out.append((uri, system.get_file_info(path).size))
    return out


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Write flat files of all texts and count each document's ids by the scan.

    Returns doc_id, file_no, ordinal (in its file), start (in its file) and n_tokens
    (with the separator) of every document; an empty table gives no row.
    """
    spark = docs.sparkSession
    order = write_flat_files(docs, fresh_path(spark, "flat"), tokenizer, end_id, dtype)
    files = sorted(r.file for r in order.select("file").distinct().collect())
    if not files:
        return spark.createDataFrame([], "doc_id long, file_no long, ordinal long, start long, n_tokens long")
    counts = scan_separators(spark, flat_sizes(files), end_id, dtype)
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("file_no")
    return counts.join(order, ["file", "ordinal"]).select("doc_id", number, "ordinal", "start", "n_tokens")
