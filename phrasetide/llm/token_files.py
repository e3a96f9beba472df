"""Token ids in Arrow files of equal-length sequences.

A file is the Arrow IPC file format: a stream of record batches with a footer of
their places. A batch holds sequences as fixed-size lists of ids and of mask
bits, so sequence n of a memory-mapped file is found by division and read
without a copy. Documents follow each other without gaps; an index file next to
each token file says where each document starts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phrasetide.llm.bpe import codec
from phrasetide.llm.common import Buckets, partitions, texts_of

LENGTH = 2048
# Sequences per record batch; also what a writing task holds in memory.
BATCH = 256
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("id", kind, False), length)),
                      ("mask", pa.list_(pa.field("real", pa.bool_(), False), length))])


class _File:
    """One Arrow file, visible under its name only when complete."""

    def __init__(self, folder: str, name: str, schema: pa.Schema):
        self.system, root = fs.FileSystem.from_uri(folder)
        self.system.create_dir(root, recursive=True)
        self.final, self.part = f"{root}/{name}", f"{root}/_{uuid.uuid4().hex}-{name}"
        self.sink = self.system.open_output_stream(self.part)
        self.writer = pa.ipc.new_file(self.sink, schema)

    def close(self) -> None:
        self.writer.close()
        self.sink.close()
        self.system.move(self.part, self.final)


class _Sequences:
    """Cuts a run of ids into sequences; the last one is padded under the mask."""

    def __init__(self, file: _File, length: int, kind: pa.DataType):
        self.file, self.length, self.schema = file, length, _schema(length, kind)
        self.kind, self.held, self.size, self.sequences = kind.to_pandas_dtype(), [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind))
        self.size += len(ids)
        if self.size >= self.length * BATCH:
            self.flush()

    def flush(self, last: bool = False) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        step = self.length * BATCH
        full = len(ids) // step * step
        for at in range(0, full, step):
            self._write(ids[at:at + step], step)
        rest = ids[full:]
        if last and len(rest):
            self._write(rest, -(-len(rest) // self.length) * self.length)
            rest = rest[:0]
        self.held, self.size = [rest], len(rest)

    def _write(self, ids: np.ndarray, room: int) -> None:
        padded = np.zeros(room, self.kind)
        padded[:len(ids)] = ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
                 for values, field in zip((padded, np.arange(room) < len(ids)), self.schema)]
        self.file.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.sequences += room // self.length


def _writer(folder: str, vocabulary: str, end_id: int, length: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        kind = pa.uint16() if len(coder.token_bytes) <= 1 << 16 else pa.uint32()
        sequences = index = None
        start = documents = 0
        for batch in batches:
            if sequences is None and batch.num_rows:
                bucket = batch.column("bucket")[0].as_py()
                tokens = _File(folder, f"tokens-{bucket:06d}.arrow", _schema(length, kind))
                sequences = _Sequences(tokens, length, kind)
                index = _File(folder, f"index-{bucket:06d}.arrow", INDEX)
            starts, sizes = [], []
            for text in batch.column("text").to_pylist():
                ids = np.append(np.frombuffer(coder.encode(text), "<u4"), np.uint32(end_id))
                sequences.add(ids)
                starts.append(start)
                sizes.append(len(ids))
                start += len(ids)
            documents += batch.num_rows
            if starts:
                index.writer.write_batch(pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64())], schema=INDEX))
        if sequences is not None:
            sequences.flush(last=True)
            tokens.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{
                "bucket": bucket, "documents": documents, "tokens": start,
                "sequences": sequences.sequences}], schema=pa.schema([
                    ("bucket", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64()),
                    ("sequences", pa.int64())]))
    return write


MANIFEST = "bucket int, documents long, tokens long, sequences long"


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0,
                 length: int = LENGTH) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, by ascending ``doc_id``.

    Ranges of ids are dealt to tasks; each writes one token file and one index
    file, and Spark writes the list of files. A task that is run again writes
    the same bytes under the same names. ``folder`` must be reachable from all
    executors. A null text is the empty one; a null ``doc_id`` comes first; rows
    with equal ids follow in order of their texts. No rows give no files.
    """
    rows = texts_of(docs)
    ranges = Buckets(rows, "doc_id", partitions(docs.sparkSession))
    (rows.withColumn("bucket", ranges.column())
     .repartitionById(ranges.count, F.col("bucket"))
     .sortWithinPartitions("doc_id", "text")
     .mapInArrow(_writer(folder, vocabulary, end_id, length), MANIFEST)
     .write.parquet(f"{folder}/manifest"))


def _open(folder: str, name: str) -> pa.ipc.RecordBatchFileReader:
    system, root = fs.FileSystem.from_uri(folder)
    if isinstance(system, fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(f"{root}/{name}"))
    return pa.ipc.open_file(system.open_input_file(f"{root}/{name}"))


def sequence(folder: str, bucket: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``n`` of a file; the ids are a view into it."""
    batch = _open(folder, f"tokens-{bucket:06d}.arrow").get_batch(n // BATCH)
    length = batch.schema.field("ids").type.list_size
    at = n % BATCH * length
    ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
    mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
    return ids[at:at + length], mask[at:at + length]


def _reader(folder: str):
    def documents(bucket: int, base: int) -> Iterator[pa.RecordBatch]:
        tokens = _open(folder, f"tokens-{bucket:06d}.arrow")
        index = _open(folder, f"index-{bucket:06d}.arrow")
        held, first, nxt = np.zeros(0, np.uint32), 0, 0  # ids from place ``first`` on
        for n in range(index.num_record_batches):
            part = index.get_batch(n)
            texts, made = [], 0
            starts, sizes = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
            done = 0
            for row, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
                pieces = [held[start - first:]] if start < first + len(held) else []
                have = sum(map(len, pieces))
                while have < size:
                    first, batch = first + len(held), tokens.get_batch(nxt)
                    held, nxt = batch.column("ids").flatten().to_numpy(zero_copy_only=True), nxt + 1
                    pieces.append(held)
                    have += len(held)
                pieces[-1] = pieces[-1][:len(pieces[-1]) - (have - size)]
                texts.append(np.concatenate(pieces).astype("<u4").tobytes())
                made += size
                if made >= 1 << 20 or row + 1 == part.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").slice(done, row + 1 - done),
                         pa.array(starts[done:row + 1] + base), pa.array(texts, pa.binary())],
                        names=["doc_id", "start", "ids"])
                    texts, made, done = [], 0, row + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                yield from documents(file["bucket"], file["base"])
    return read


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` from the files.

    ``ids`` are packed as little-endian unsigned 32-bit integers, end id included.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per file: the running sum over them is small.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("bucket", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    count = max(1, partitions(spark))
    return (placed.repartitionById(count, F.pmod("bucket", F.lit(count)))
            .mapInArrow(_reader(folder), "doc_id long, start long, ids binary"))
