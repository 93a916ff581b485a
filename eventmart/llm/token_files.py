"""Operator 1: token ids in bit-packed files.

A file holds the documents of one range of ids, in ascending order. Every id takes
the minimum bits of the vocabulary (16 for 50,257 ids). Layout::

    block 0 | block 1 | ... | footer | footer length (8 bytes) | MAGIC

Ids are packed in blocks of ``BLOCK_IDS``; a block starts at a byte, and its offset
is in the footer, together with the bit width, the id counts, and for each document its
id and where it ends. So a reader unpacks any block alone with a few numpy operations,
and any document from the blocks it touches.

Files are written by Spark tasks through ``pyarrow.fs`` to the shared folder, under a
name of the attempt that is then moved to the final name: a repeated or speculative
task writes the same bytes again. Only the manifest (one row per file) is collected.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import lean, slices, width
from eventmart.llm.tokens import ENCODE_BYTES, encoder
from eventmart.session import fresh_path

MAGIC = b"EMTOKENS"
#: A multiple of 8, so that a block is a whole number of bytes at any width.
BLOCK_IDS = 8192
#: Blocks read at a time.
READ_BLOCKS = 64

MANIFEST = "file string, part long, n_docs long, n_ids long"


def bits_for(vocabulary: int) -> int:
    """Minimum bits of ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit string of the ids, ``bits`` each, padded with zeros to 8 ids.

    Eight ids take ``bits`` bytes: lane j of all groups of eight is shifted at once.
    """
    groups = -(-len(ids) // 8)
    lanes = np.zeros((groups, 8), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    out = np.zeros((groups, bits + 8), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        v = lanes[:, j] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, byte + k] |= (v >> np.uint64(8 * k)).astype(np.uint8)
    return out[:, :bits].tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a packed block."""
    raw = np.frombuffer(data, np.uint8).reshape(-1, bits)
    rows = np.zeros((len(raw), bits + 8), np.uint8)
    rows[:, :bits] = raw
    lanes = np.empty((len(raw), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        v = np.zeros(len(raw), np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            v |= rows[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        lanes[:, j] = (v >> np.uint64(shift)) & mask
    return lanes.reshape(-1)[:n]


class Writer:
    """Packs ids into one file as they come; holds at most one block and the footer."""

    def __init__(self, sink, bits: int):
        self.sink, self.bits, self.at, self.n_ids = sink, bits, 0, 0
        self.offsets: list[int] = []
        self.ends: list[int] = []
        self.doc_ids: list[int | None] = []
        self.rest = np.empty(0, np.uint32)

    def add(self, ids: np.ndarray, ends: list[int], doc_ids: list[int | None]) -> None:
        """Ids of some documents in a row; ``ends`` count from the first of them."""
        self.ends += [self.n_ids + e for e in ends]
        self.doc_ids += doc_ids
        self.n_ids += len(ids)
        rest = np.concatenate([self.rest, ids])
        whole = len(rest) // BLOCK_IDS * BLOCK_IDS
        self._put(rest[:whole])
        self.rest = rest[whole:]

    def _put(self, ids: np.ndarray) -> None:
        size = BLOCK_IDS // 8 * self.bits
        self.offsets += range(self.at, self.at + -(-len(ids) // BLOCK_IDS) * size, size)
        data = pack(ids, self.bits)
        self.sink.write(data)
        self.at += len(data)

    def close(self) -> None:
        if len(self.rest):
            self._put(self.rest)
        footer = pa.table(
            {"offsets": [self.offsets], "ends": [self.ends], "doc_ids": [self.doc_ids], "bits": [self.bits], "n_ids": [self.n_ids]},
            pa.schema([("offsets", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("bits", pa.int32()), ("n_ids", pa.int64())]),
        )
        with (buffer := pa.BufferOutputStream()) as sink, pa.ipc.new_stream(sink, footer.schema) as out:
            out.write_table(footer)
        data = buffer.getvalue().to_pybytes()
        self.sink.write(data + len(data).to_bytes(8, "little") + MAGIC)


class Reader:
    """Random access to a file: any block, any run of ids, any document."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.source = system.open_input_file(path)
        size = self.source.size()
        tail = self.source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        n = int.from_bytes(tail[:8], "little")
        footer = pa.ipc.open_stream(self.source.read_at(n, size - 16 - n)).read_all()
        self.bits, self.n_ids = footer["bits"][0].as_py(), footer["n_ids"][0].as_py()
        self.offsets, self.ends = (footer[c][0].values.to_numpy() for c in ("offsets", "ends"))
        self.doc_ids: list[int | None] = footer["doc_ids"][0].as_py()

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end``, from the blocks that hold them."""
        if end <= begin:
            return np.empty(0, np.uint32)
        first, last = begin // BLOCK_IDS, (end - 1) // BLOCK_IDS
        at = int(self.offsets[first])
        n = min(self.n_ids, (last + 1) * BLOCK_IDS) - first * BLOCK_IDS
        size = int(self.offsets[last]) - at + -(-min(self.n_ids - last * BLOCK_IDS, BLOCK_IDS) // 8) * self.bits
        return unpack(self.source.read_at(size, at), self.bits, n)[begin - first * BLOCK_IDS : end - first * BLOCK_IDS]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text`` in ranges of ascending ids; repeated ids are ordered by their text."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = width(docs.sparkSession)
    return rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")


def encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, special_as_text: bool = False) -> Iterator[tuple[list, list[bytes]]]:
    """Ids of documents, and the ids of their texts, slice by slice."""
    own = encoder(tokenizer, special_as_text)
    try:
        for batch in batches:
            for part in slices(batch, "text", ENCODE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield part.column("doc_id").to_pylist(), own.encode(texts)
    finally:
        # the worker lives on and runs tasks of other stages
        own.clear()


def to_file(uri: str, write: Callable) -> None:
    """Run ``write(sink)`` on a file of this attempt, then move it to ``uri``."""
    system, path = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    attempt = f"{folder}/_attempt-{uuid.uuid4().hex}-{name}"
    with system.open_output_stream(attempt) as sink:
        write(sink)
    if system.type_name != "local" and system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_file(path)
    system.move(attempt, path)


def uri_of(path: str) -> str:
    return path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:/") else f"file://{path}"


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int, vocabulary: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Encode every whole text, append ``end_id`` to each, and write the packed files.

    Nulls count as empty texts; null ids come first. An empty table gives no file.
    ``vocabulary`` is the tokenizer's size unless stated. Returns the manifest in
    file order. ``out`` has to be a folder that all executors and pyarrow reach.
    """
    out = uri_of(out)

    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = encoded(batches, tokenizer)
        first = next(rows, None)
        if first is None:
            return
        size = max(vocabulary or encoder(tokenizer).vocabulary, end_id + 1)
        part = TaskContext.get().partitionId()
        uri, made = f"{out}/part-{part:06d}.tok", {}

        def fill(sink) -> None:
            writer = made["writer"] = Writer(sink, bits_for(size))
            end, found = int(end_id).to_bytes(4, "little"), first
            while found is not None:
                doc_ids, texts = found
                ids = np.frombuffer(b"".join(t + end for t in texts), "<u4")
                writer.add(ids, np.cumsum([len(t) // 4 + 1 for t in texts]).tolist(), doc_ids)
                found = next(rows, None)
            writer.close()

        to_file(uri, fill)
        done = made["writer"]
        yield pa.RecordBatch.from_pylist([{"file": uri, "part": part, "n_docs": len(done.ends), "n_ids": done.n_ids}])

    files = in_order(docs, id_col, text_col).mapInArrow(write, MANIFEST)
    return sorted((r.asDict() for r in files.collect()), key=lambda f: f["part"])


def read_token_files(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """One row per document, read from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is taken over
    its ids as little-endian unsigned 32-bit integers. A task reads whole files, some
    blocks at a time.
    """
    rows, start = [], 0
    for f in manifest:
        rows.append((f["file"], start))
        start += f["n_ids"]

    @lean
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(batch.column(c).to_pylist() for c in ("file", "base")), strict=True):
                yield from _documents(Reader(uri), base)

    # from an Arrow table: a list would go through Python workers of another pool, which stay
    names = pa.table([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["file", "base"])
    files = spark.createDataFrame(names).repartition(max(1, len(rows)))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(reader: Reader, base: int) -> Iterator[pa.RecordBatch]:
    ends, k, crc = reader.ends, 0, 0
    step = READ_BLOCKS * BLOCK_IDS
    for begin in range(0, reader.n_ids, step):
        data = memoryview(reader.ids(begin, min(begin + step, reader.n_ids)).astype("<u4").tobytes())
        done, at = [], begin
        while k < len(ends) and ends[k] <= begin + len(data) // 4:
            done.append(zlib.crc32(data[4 * (at - begin) : 4 * (int(ends[k]) - begin)], crc))
            at, crc, k = int(ends[k]), 0, k + 1
        crc = zlib.crc32(data[4 * (at - begin) :], crc)
        own = slice(k - len(done), k)
        starts = np.concatenate([[ends[own.start - 1] if own.start else 0], ends[own][:-1]])[: len(done)]
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(reader.doc_ids[own], pa.int64()), pa.array(starts + base, pa.int64()), pa.array(ends[own] - starts, pa.int64()), pa.array(done, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def token_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, fresh_path(spark, "tokens"), tokenizer, end_id)
    if not manifest:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(spark, manifest)
