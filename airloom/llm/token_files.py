"""Token ids in binary files of patched frame-of-reference blocks.

Documents are range-partitioned by id, and every task writes the ids of its range, in order, into
files of its own. A file holds

* blocks of ``BLOCK`` ids: the smallest id of the block, the differences to it packed at the width that
  a share of ``PERCENTILE`` of them fits, and the others as exceptions (place, difference);
* an index of the byte at which every block starts, so that any run of ids is read without the rest;
* the documents (id, number of ids) as an Arrow stream, and a footer with places and a checksum.

A task names its files anew on every attempt and reports them as rows of the manifest, which Spark
commits; files that the manifest does not name come from lost attempts and are never read. Only the
manifest, a row per file, is summed up for the places of the files among all ids. Files are opened by
``pyarrow.fs``, so the folder may be any that driver and executors reach by the same address.

Defined cases: a null text is empty, so it is the end id alone. Null ids come first; rows that repeat
an id lie together, ordered by a hash of their texts. A very long text spans blocks, and is read back
block by block. An empty table gives a manifest without rows. Only id and text are read, so further
columns and their names do not matter. A damaged file is an error.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.llm.common import bounded_batches, chunks, text_of
from airloom.llm.packing import _encoder, default_tokenizer

#: Ids of a block.
BLOCK = 1024
#: Share of a block's differences that its width must fit.
PERCENTILE = 0.9
#: A file that has so many ids is closed behind the document that reaches them.
FILE_IDS = 1 << 24
#: Ids that are decoded together at most.
STEP = 1 << 18

MAGIC = b"AIRLPFR1"
_BLOCK_HEAD = struct.Struct("<IHHB")  # smallest id, ids, exceptions, width
_FOOTER = struct.Struct("<QQQIII8s")  # ids, byte of the index, byte of the documents, block, checksum, blocks, magic


# --- blocks -----------------------------------------------------------------------------

def pack_block(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1 to 65,535 unsigned 32-bit values."""
    base = values.min()
    rest = (values - base).astype("<u4")
    rank = max(0, math.ceil(percentile * len(rest)) - 1)
    width = int(np.partition(rest, rank)[rank]).bit_length()
    far = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = np.unpackbits(rest.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    head = _BLOCK_HEAD.pack(int(base), len(rest), len(far), width)
    return head + far.astype("<u2").tobytes() + rest[far].tobytes() + np.packbits(bits, bitorder="little").tobytes()


def unpack_block(data: bytes) -> np.ndarray:
    base, n, exceptions, width = _BLOCK_HEAD.unpack_from(data)
    at = _BLOCK_HEAD.size
    far = np.frombuffer(data, "<u2", exceptions, at)
    differences = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    packed = np.frombuffer(data, np.uint8, -1, at + 6 * exceptions)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    rest = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    rest[far] = differences
    return rest + np.uint32(base)


# --- files ------------------------------------------------------------------------------

def _opened(path: str):
    """(file system, path within it) of a folder or file, given as Spark or Hadoop write it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


class FileWriter:
    """Writes the ids of documents, one after the other, to a binary file-like object."""

    def __init__(self, sink, id_type: pa.DataType, block: int = BLOCK, percentile: float = PERCENTILE):
        self.sink, self.id_type, self.block, self.percentile = sink, id_type, block, percentile
        self.keys: list = []
        self.lengths: list[int] = []
        self.starts: list[int] = []
        self.n_ids = 0
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self._at = sink.write(MAGIC) or len(MAGIC)

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        self._held.append(ids)
        self._n_held += len(ids)
        if self._n_held >= 64 * self.block:
            self._flush(self._n_held // self.block * self.block)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self._held) if self._held else np.empty(0, np.uint32)
        for a in range(0, n, self.block):
            data = pack_block(ids[a:min(n, a + self.block)], self.percentile)
            self.starts.append(self._at)
            self.sink.write(data)
            self._at += len(data)
        self._held, self._n_held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self._n_held)
        index = np.array([*self.starts, self._at], "<u8").tobytes()
        documents = pa.BufferOutputStream()
        rows = pa.table({"id": pa.array(self.keys, self.id_type), "n": pa.array(self.lengths, pa.int64())})
        with pa.ipc.new_stream(documents, rows.schema) as stream:
            stream.write_table(rows)
        tail = index + documents.getvalue().to_pybytes()
        self.sink.write(tail + _FOOTER.pack(self.n_ids, self._at, self._at + len(index), self.block,
                                            zlib.crc32(tail), len(self.starts), MAGIC))


class FileReader:
    """Documents and any run of ids of a file that can seek."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - _FOOTER.size)
        self.n_ids, index_at, documents_at, self.block, checksum, n_blocks, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        source.seek(index_at)
        tail = source.read(size - _FOOTER.size - index_at)
        if zlib.crc32(tail) != checksum:
            raise ValueError("index and documents do not have their checksum")
        self.starts = np.frombuffer(tail, "<u8", n_blocks + 1)
        rows = pa.ipc.open_stream(tail[documents_at - index_at:]).read_all()
        self.keys = rows.column("id").combine_chunks()
        self.lengths = rows.column("n").to_numpy()
        self.ends = np.cumsum(self.lengths)
        self._window = (0, 0, b"")  # blocks from, to, and their bytes
        self._last = (-1, np.empty(0, np.uint32))

    def _decoded(self, i: int) -> np.ndarray:
        if self._last[0] == i:
            return self._last[1]
        first, end, data = self._window
        if not first <= i < end:
            first, end = i, min(len(self.starts) - 1, i + STEP // self.block + 1)
            self.source.seek(int(self.starts[first]))
            data = self.source.read(int(self.starts[end] - self.starts[first]))
            self._window = first, end, data
        a, b = (int(self.starts[k] - self.starts[first]) for k in (i, i + 1))
        self._last = i, unpack_block(data[a:b])
        return self._last[1]

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids ``a`` to ``b`` (end exclusive) of the file."""
        found = [self._decoded(i)[max(0, a - i * self.block):max(0, b - i * self.block)]
                 for i in range(a // self.block, -(-b // self.block))]
        return np.concatenate(found) if found else np.empty(0, np.uint32)

    def crc32(self, a: int, b: int) -> int:
        """Of the ids as little-endian 32-bit integers, a step at a time."""
        crc = 0
        for x in range(a, b, STEP):
            crc = zlib.crc32(self.ids(x, min(b, x + STEP)).astype("<u4").tobytes(), crc)
        return crc


# --- Spark ------------------------------------------------------------------------------

def write(
    df: DataFrame, path: str, *, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None,
    end_id: int = 0, block: int = BLOCK, percentile: float = PERCENTILE, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of all texts below ``path``, in order of the document ids; returns the manifest.

    The manifest has a row per file: ``part`` and ``seq`` order the files, ``file`` is its name,
    ``first_id`` and ``last_id`` bound its documents, ``n_docs`` and ``n_ids`` count them, and
    ``start`` is the number of ids in all files before it.
    """
    spark, vocabulary, folder = df.sparkSession, tokenizer or default_tokenizer(), path.rstrip("/")
    kind = df.schema[id_column].dataType.simpleString()
    # Rows that repeat an id and a text are told apart by a random number, so that copies are shared out, too.
    keyed = df.select(F.col(id_column).alias("id"), text_of(text).alias("text")).select(
        "id", "text", F.xxhash64("text").alias("digest"), F.rand(13).alias("salt"))
    order = ["id", "digest", "salt"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = _encoder(vocabulary), TaskContext.get().partitionId(), 0
        files, root = _opened(folder)
        name = sink = writer = None

        def close() -> pa.RecordBatch:
            writer.close()
            sink.close()
            ends = pa.array([writer.keys[0]], writer.id_type), pa.array([writer.keys[-1]], writer.id_type)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([name]), *ends,
                 pa.array([len(writer.keys)], pa.int64()), pa.array([writer.n_ids], pa.int64())],
                names=["part", "seq", "file", "first_id", "last_id", "n_docs", "n_ids"])

        try:
            for batch in chunks(batches, "text"):
                keys, texts = batch.column("id"), batch.column("text")
                for i in range(batch.num_rows):
                    if writer is None:
                        name = f"ids-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.pfor"
                        files.create_dir(root, recursive=True)
                        sink = files.open_output_stream(f"{root}/{name}")
                        writer = FileWriter(sink, keys.type, block, percentile)
                    writer.add(keys[i].as_py(), np.append(encode(texts[i].as_py()), np.uint32(end_id)))
                    if writer.n_ids >= file_ids:
                        yield close()
                        writer, seq = None, seq + 1
            if writer is not None:
                yield close()
        except BaseException:
            if writer is not None:
                sink.close()
                files.delete_file(f"{root}/{name}")
            raise

    bounded_batches(spark)
    files = ordered.mapInArrow(
        run, f"part int, seq int, file string, first_id {kind}, last_id {kind}, n_docs bigint, n_ids bigint")
    files.write.parquet(f"{folder}/files")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = spark.read.schema(files.schema).parquet(f"{folder}/files").withColumn(
        "start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("bigint")))
    placed.write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/manifest")


def read(spark: SparkSession, path: str, *, id_column: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document of the files: the id, ``start`` among all ids, ``n_tokens``, ``ids_crc32``
    (of its ids as little-endian unsigned 32-bit integers), and ``ids`` on request."""
    folder = path.rstrip("/")
    listed = manifest(spark, folder)
    kind = listed.schema["first_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _opened(folder)
        for row in (row for batch in batches for row in batch.to_pylist()):
            with files.open_input_file(f"{root}/{row['file']}") as source:
                reader = FileReader(source, source.size())
                if (reader.n_ids, len(reader.keys)) != (row["n_ids"], row["n_docs"]):
                    raise ValueError(f"{row['file']} is not the file of the manifest")
                yield from _documents(reader, row["start"], id_column, with_ids)

    spread = listed.repartition(max(1, listed.count())).select("file", "start", "n_docs", "n_ids")
    fields = f"`{id_column}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return spread.mapInArrow(run, fields + ", ids array<bigint>" * with_ids)


def _documents(reader: FileReader, start: int, id_column: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    i, begins = 0, reader.ends - reader.lengths
    while i < len(reader.ends):
        j = max(i + 1, int(np.searchsorted(reader.ends, begins[i] + STEP, "right")))
        spans = [(int(a), int(b)) for a, b in zip(begins[i:j], reader.ends[i:j])]
        columns = {
            id_column: reader.keys.slice(i, j - i),
            "start": pa.array(begins[i:j] + start, pa.int64()),
            "n_tokens": pa.array(reader.lengths[i:j], pa.int64()),
            "ids_crc32": pa.array([reader.crc32(a, b) for a, b in spans], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([reader.ids(a, b) for a, b in spans], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        i = j
