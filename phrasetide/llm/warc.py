"""Web archives through a chunked record table.

Payloads become rows of record id, chunk number and chunk, so no Python worker
ever holds a whole one. Writers stream the chunks of a record into its archive
member; readers stream them out again. Both carry the SHA-1 of what has passed,
and a reader fails where it differs from the digest that the record states.
Archives are WARC 1.1 with one gzip member per record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasetide.llm.common import partitions, small_batches, written

CHUNK = 64 * 1024
# Payloads below this many bytes are stored every time.
LEAST_SHARED = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PREFIX = "urn:page:"

RECORDS = ("record_id long, copy long, chunk_no int, chunk binary, chunks int, url string, "
           "payload_bytes long, payload_sha1 string, refers_to long")


def with_references(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``page_id``, ``url``, ``html`` as binary, its size and SHA-1, and ``refers_to``.

    Of pages with equal payloads of at least ``least`` bytes all but the one with
    the largest ``page_id`` refer to that one. Digests are grouped with map-side
    aggregation, and only pages that repeat are joined; a null page is empty. Rows
    that share a ``page_id`` refer each by its own payload. A row without an id is
    never a reference nor referred to.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", body.alias("payload")).select(
        "*", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_sha1"))
    narrow = written(rows.filter(F.col("payload_bytes") >= least)
                     .select("page_id", "payload_sha1"), "payload-digests")
    shared = written(narrow.groupBy("payload_sha1").agg(
        F.max("page_id").alias("last_id"), F.count("*").alias("n")).filter("n > 1")
        .select(F.col("payload_sha1").alias("shared_sha1"), "last_id"), "shared-payloads")
    revisits = written(narrow.join(shared, F.col("payload_sha1") == F.col("shared_sha1"))
                       .filter("page_id < last_id")
                       .select(F.col("page_id").alias("revisit_id"),
                               F.col("payload_sha1").alias("revisit_sha1"),
                               F.col("last_id").alias("refers_to")).distinct(), "revisits")
    return (rows.join(revisits, (F.col("page_id") == F.col("revisit_id"))
                      & (F.col("payload_sha1") == F.col("revisit_sha1")), "left")
            .drop("revisit_id", "revisit_sha1"))


def chunked(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The record table of ``with_references`` rows: one row per chunk of a payload.

    An empty payload is one empty chunk; so is that of a revisit, which isn't
    stored again. ``copy`` tells rows apart that are equal in all columns.
    """
    stored = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(stored) / chunk)).cast("int")
    numbers = F.sequence(F.lit(0), count - 1)
    return (small_batches(pages).withColumn("chunks", count)
            .withColumn("stored", stored)
            .withColumn("copy", F.monotonically_increasing_id())
            .withColumn("chunk_no", F.explode(numbers))
            .select(F.col("page_id").alias("record_id"), "copy", "chunk_no",
                    F.substring("stored", F.col("chunk_no") * chunk + 1, F.lit(chunk))
                    .alias("chunk"),
                    "chunks", "url", "payload_bytes", "payload_sha1", "refers_to"))


def _digest(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _urn(page_id: int | None) -> str:
    return f"<{_PREFIX}{'' if page_id is None else page_id}>"


def _head(row: dict) -> bytes:
    """Record header and, in its block, the header of the response."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    revisit = row["refers_to"] is not None
    url = "".join(c if 32 < ord(c) else "%%%02X" % ord(c) for c in row["url"] or "")
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
              f"WARC-Record-ID: {_urn(row['record_id'])}", f"WARC-Date: {DATE}",
              f"WARC-Target-URI: {url}",
              "Content-Type: application/http; msgtype=response",
              f"WARC-Payload-Digest: {_digest(row['payload_sha1'])}"]
    if revisit:
        fields += [f"WARC-Profile: {PROFILE}",
                   f"WARC-Refers-To: {_urn(row['refers_to'])}"]
    length = len(http) + (0 if revisit else row["payload_bytes"])
    fields.append(f"Content-Length: {length}")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + http


MANIFEST = "file string, records long"


def _writer(folder: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        temporary = f"{root}/_{uuid.uuid4().hex}-{name}"
        sink = member = seen = None
        records = 0
        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(temporary, compression=None)
                if row["chunk_no"] == 0:
                    member, seen = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha1()
                    sink.write(member.compress(_head(row)))
                seen.update(row["chunk"])
                sink.write(member.compress(row["chunk"]))
                if row["chunk_no"] + 1 == row["chunks"]:
                    if row["refers_to"] is None and seen.hexdigest() != row["payload_sha1"]:
                        raise ValueError(f"chunks of record {row['record_id']} are not its payload")
                    sink.write(member.compress(b"\r\n\r\n") + member.flush())
                    records += 1
        if sink is not None:
            sink.close()
            system.move(temporary, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [records]})
    return write


def write_archives(records: DataFrame, folder: str, level: int = 1) -> None:
    """Write the record table as archives under ``folder``, and the list of them.

    Records are dealt by their id and payload, so copies of a payload under other
    ids don't meet; each task streams its chunks in order into one archive. A task
    that is run again writes the same archive under the same name. ``folder`` must
    be reachable from all executors. Rows that repeat an id are records of one id
    each; those without one have the record id ``<urn:page:>`` and are read back
    with a null id.
    """
    (records.repartition("record_id", "payload_sha1")
     .sortWithinPartitions("record_id", "url", "payload_sha1", "copy", "chunk_no")
     .mapInArrow(_writer(folder, level), MANIFEST)
     .write.parquet(f"{folder}/manifest"))


class _Source:
    """Reads a file of gzip members piece by piece."""

    def __init__(self, stream):
        self.stream, self.raw, self.held = stream, b"", b""
        self.member = None

    def _more(self, limit: int) -> bool:
        """Decompress some more; False at the end of the file."""
        if self.member is None or self.member.eof:
            rest = self.member.unused_data if self.member else b""
            self.raw = rest or self.stream.read(CHUNK)
            if not self.raw:
                return False
            self.member = zlib.decompressobj(31)
        got = self.member.decompress(self.raw, limit)
        self.raw = self.member.unconsumed_tail
        if not got and not self.raw and not self.member.eof:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                raise ValueError("archive ends within a record")
        self.held += got
        return True

    def line(self) -> bytes | None:
        while (at := self.held.find(b"\n")) < 0:
            if not self._more(CHUNK):
                return None
        found, self.held = self.held[:at + 1], self.held[at + 1:]
        return found

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._more(CHUNK):
                raise ValueError("archive ends within a record")
        found, self.held = self.held[:size], self.held[size:]
        return found

    def fields(self) -> dict[str, str] | None:
        """The header up to its empty line; None at the end of the file."""
        line = self.line()
        while line is not None and not line.strip():
            line = self.line()
        if line is None:
            return None
        found = {"": line.strip().decode()}
        while (line := self.line()) is not None and line.strip():
            name, _, value = line.decode().partition(":")
            found[name.strip().lower()] = value.strip()
        return found


CHUNKS = ("record_id long, record_type string, refers_to long, chunk_no int, chunk binary, "
          "last boolean, upto_bytes long, upto_sha1 string, payload_sha1 string")
_FIELDS = [part.split()[0] for part in CHUNKS.split(", ")]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.int64(),
          pa.string(), pa.string()]


def _page(reference: str | None) -> int | None:
    page_id = (reference or "").strip("<>").removeprefix(_PREFIX)
    return int(page_id) if page_id else None


def _records(source: _Source) -> Iterator[tuple]:
    while (head := source.fields()) is not None:
        if not head[""].startswith("WARC/"):
            raise ValueError(f"not a record: {head['']!r}")
        left = int(head["content-length"])
        stated = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        while (line := source.line()) is not None:  # the response's own header
            left -= len(line)
            if not line.strip():
                break
        seen, number, size = hashlib.sha1(), 0, 0
        stored = head["warc-type"] == "response"
        while True:
            chunk = source.take(min(left, CHUNK))
            left -= len(chunk)
            size += len(chunk)
            seen.update(chunk)
            if stored and not left and seen.hexdigest() != stated:
                raise ValueError(f"payload of {head['warc-record-id']} isn't what it states")
            yield (_page(head["warc-record-id"]), head["warc-type"],
                   _page(head.get("warc-refers-to")), number, chunk, not left, size,
                   seen.hexdigest(), stated)
            number += 1
            if not left:
                break


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for row in _records(_Source(stream)):
                        rows.append(row)
                        held += len(row[4]) + 200
                        if held >= 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)
    return read


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_FIELDS)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk rows of all archives under ``folder``.

    ``upto_bytes`` and ``upto_sha1`` are those of the payload up to the end of
    the chunk. A revisit has one empty chunk and the digest of what it refers to.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # Dealt by number: names are few bytes, which adaptive execution would hand
    # to one task together with all the archives behind them.
    count = max(1, partitions(spark))
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    return (files.repartitionById(count, F.pmod(number, F.lit(count)))
            .mapInArrow(_reader(folder), CHUNKS))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: id, type, size and SHA-1 of the full payload, and its reference.

    A revisit's size is that of the record it refers to.
    """
    last = (read_chunks(spark, folder).filter("last")
            .select("record_id", "record_type", "refers_to", "upto_bytes", "payload_sha1"))
    records = written(last, "records")
    referred = written(records.filter("refers_to is not null")
                       .select(F.col("refers_to").alias("referred_id"),
                               F.col("payload_sha1").alias("referred_sha1")).distinct(),
                       "referred")
    referred_to = F.col("payload_sha1") == F.col("referred_sha1")
    sizes = written(records.filter("record_type = 'response'")
                    .join(referred, (F.col("record_id") == F.col("referred_id")) & referred_to)
                    .groupBy("referred_id", "referred_sha1")
                    .agg(F.first("upto_bytes").alias("full_bytes")), "referred-sizes")
    return (records.join(sizes, (F.col("refers_to") == F.col("referred_id")) & referred_to, "left")
            .select("record_id", "record_type",
                    F.coalesce("full_bytes", "upto_bytes").alias("payload_bytes"),
                    F.col("payload_sha1").alias("payload_digest"), "refers_to"))
