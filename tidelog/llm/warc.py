"""WARC archives as a table of record chunks: written and read back piece by piece."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import work_dir
from tidelog.sinks.tables import written_table

CHUNK = 64 * 1024           # bytes of a payload in one row
FILE_BYTES = 256 * 1024 * 1024  # a new archive file is begun beyond this
MIN_REVISIT = 1000          # payloads below are always stored
DATE = "1970-01-01T00:00:00Z"  # capture time where none is given
# fixed value of the format
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

CHUNK_SCHEMA = ("record_id string, record_type string, refers_to string, target_uri string, payload_bytes long, "
                "chunk_no long, data binary, upto long, digest string, last boolean")
_OUT = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
                  ("payload_bytes", pa.int64()), ("chunk_no", pa.int64()), ("data", pa.binary()), ("upto", pa.int64()),
                  ("digest", pa.string()), ("last", pa.bool_())])


def with_revisits(records: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``records`` (``record_id``, ``target_uri``, ``payload`` binary) with sizes, digest, type and ``refers_to``.

    Of records with equal payloads of ``min_bytes`` or more the one with the largest
    ``record_id`` is the response, the others are revisits that refer to it; rows that
    repeat that id are responses too. A null payload counts as empty. A null id is a
    revisit where another record has the payload.
    """
    payload = F.coalesce("payload", F.lit("").cast("binary"))
    sized = records.select("record_id", "target_uri", payload.alias("payload"))
    sized = sized.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("__same", F.sha2("payload", 256))
    winners = sized.filter(F.col("payload_bytes") >= min_bytes).groupBy("__same").agg(
        F.max("record_id").alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    joined = sized.join(winners.hint("shuffle_hash"), "__same", "left")
    revisit = F.col("__first").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("__first"))
    return joined.select(
        "record_id", "target_uri", "payload", "payload_bytes", F.sha1("payload").alias("digest"),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("__first")).alias("refers_to"))


def chunked(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row per chunk of each payload (one row of no bytes for revisits and empty payloads), in order within a record."""
    stored = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    count = F.greatest(F.lit(1), F.ceil(stored / chunk)).cast("long")
    rows = records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    start, length = (F.col("chunk_no") * chunk + 1).cast("int"), F.when(stored > 0, F.lit(chunk)).otherwise(F.lit(0))
    return rows.withColumn("data", F.substring("payload", start, length)).drop("payload")


def _uri(text: str | None) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text or "urn:none")


def _record_uri(record_id: int | None) -> str:
    return f"<urn:record:{'null' if record_id is None else record_id}>"


def _headers(row: dict) -> bytes:
    """WARC header and the HTTP header that begins the block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    lines = ["WARC/1.0", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_record_uri(row['record_id'])}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {_uri(row['target_uri'])}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['digest'])).decode()}"]
    body = row["payload_bytes"]
    if row["record_type"] == "revisit":
        body = 0
        lines += [f"WARC-Refers-To: {_record_uri(row['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + body}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Writer:
    """The archive files of one task; a record's chunks are compressed and hashed as they come."""

    def __init__(self, folder: str):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.file = self.record = None
        self.done: list[tuple[str, int, int]] = []

    def add(self, row: dict) -> None:
        if row["chunk_no"] == 0:
            self.end_record()
            if self.file is None or self.file.tell() > FILE_BYTES:
                self.end_file()
                self.path = f"{self.folder}/part-{uuid.uuid4().hex}.warc.gz"
                self.file, self.records = self.store.open_output_stream(self.path, compression=None), 0
            self.record, self.zip, self.sha, self.next = row, zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1(), 0
            self.file.write(self.zip.compress(_headers(row)))
        if self.record is None or row["record_id"] != self.record["record_id"] or row["chunk_no"] != self.next:
            raise ValueError(f"chunk {row['chunk_no']} of record {row['record_id']} is out of order")
        self.next += 1
        self.sha.update(row["data"] or b"")
        self.file.write(self.zip.compress(row["data"] or b""))

    def end_record(self) -> None:
        if self.record is None:
            return
        if self.record["record_type"] == "response" and self.sha.hexdigest() != self.record["digest"]:
            raise ValueError(f"record {self.record['record_id']} does not have its digest")
        self.file.write(self.zip.compress(b"\r\n\r\n") + self.zip.flush())
        self.records, self.record = self.records + 1, None

    def end_file(self) -> None:
        self.end_record()
        if self.file is not None:
            self.done.append((self.path, self.records, self.file.tell()))
            self.file.close()
            self.file = None


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write chunk rows as WARC files in ``folder``: ``path``, ``records``, ``bytes`` of each file.

    The chunks of a record must follow each other in order in one partition, as
    ``chunked`` leaves them. Each record is a gzip member of its own. The list of files
    is a written table, and only files it names count: those of lost or repeated tasks
    have names of their own and are never read.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for row in batch.to_pylist():
                writer = writer or _Writer(folder)
                writer.add(row)
        if writer:
            writer.end_file()
            yield pa.RecordBatch.from_pylist([dict(zip(("path", "records", "bytes"), d)) for d in writer.done],
                                             pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    columns = chunks.select("record_id", "target_uri", "payload_bytes", "digest", "record_type", "refers_to", "chunk_no", "data")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return written_table(columns.mapInArrow(write, "path string, records long, bytes long"))


def _members(stream: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The uncompressed bytes of each gzip member, in pieces of at most a chunk."""
    rest = stream.read(CHUNK)
    while rest:
        unzip = zlib.decompressobj(31)

        def pieces() -> Iterator[bytes]:
            nonlocal rest
            while not unzip.eof:
                if not rest:
                    rest = stream.read(CHUNK)
                    if not rest:
                        raise ValueError("the archive ends within a record")
                out = unzip.decompress(rest, CHUNK)
                rest = unzip.unused_data if unzip.eof else unzip.unconsumed_tail
                if out:
                    yield out
        yield pieces()
        rest = rest or stream.read(CHUNK)


def _head(buffer: bytearray, pieces: Iterator[bytes]) -> dict[str, str]:
    """Take a header off the front of ``buffer``, however long its URI; header names in lower case."""
    searched = 0
    while (end := buffer.find(b"\r\n\r\n", searched)) < 0:
        searched = max(0, len(buffer) - 3)
        try:
            buffer += next(pieces)
        except StopIteration:
            raise ValueError("a header has no end") from None
    lines = bytes(buffer[:end]).decode("utf-8", "replace").split("\r\n")
    del buffer[:end + 4]
    fields = (line.partition(":") for line in lines[1:])
    return {"": lines[0]} | {name.strip().lower(): value.strip() for name, _, value in fields}


def _record_rows(pieces: Iterator[bytes], chunk: int) -> Iterator[dict]:
    buffer = bytearray()
    head = _head(buffer, pieces)
    if not head[""].startswith("WARC/"):
        raise ValueError("not a WARC record")
    block = int(head["content-length"])
    before = len(buffer)
    taken = 0

    def counted() -> Iterator[bytes]:
        nonlocal taken
        for piece in pieces:
            taken += len(piece)
            yield piece

    counter = counted()
    http = _head(buffer, counter)
    left = block - (before + taken - len(buffer))  # payload bytes stored
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    row = {"record_id": head["warc-record-id"], "record_type": head["warc-type"], "refers_to": head.get("warc-refers-to"),
           "target_uri": head["warc-target-uri"], "payload_bytes": int(http["content-length"])}
    if row["record_type"] == "revisit":
        for _ in counter:  # to the end of the record
            pass
        yield row | {"chunk_no": 0, "data": None, "upto": 0, "digest": digest, "last": True}
        return
    sha, upto, number = hashlib.sha1(), 0, 0
    while True:
        while len(buffer) < min(chunk, left):
            buffer += next(counter)
        data = bytes(buffer[:min(chunk, left)])
        del buffer[:len(data)]
        left, upto = left - len(data), upto + len(data)
        sha.update(data)
        yield row | {"chunk_no": number, "data": data, "upto": upto, "digest": sha.hexdigest(), "last": left == 0}
        number += 1
        if not left:
            break
    tail = bytes(buffer) + b"".join(counter)
    if tail != b"\r\n\r\n" or sha.hexdigest() != digest:
        raise ValueError(f"record {row['record_id']} is damaged")


def read_chunks(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of the archives named by ``files`` (``path``).

    A row per chunk of at most ``chunk`` bytes: the record's id, type, reference, URI and
    payload size, ``chunk_no`` from 0, ``data``, the bytes so far (``upto``), the SHA-1
    of the payload so far (``digest``, lower-case hex) and whether it is the ``last``.
    No more than a few chunks are held at a time, however long the record. A revisit is
    one row without data, with the digest and size of the full payload from its headers.
    Each response is checked against its digest; damaged or cut-off archives fail.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows, held = [], 0
                store, inside = fs.FileSystem.from_uri(path)
                with store.open_input_stream(inside, compression=None) as stream:
                    for pieces in _members(stream):
                        for row in _record_rows(pieces, chunk):
                            rows.append(row)
                            held += len(row["data"] or b"")
                            if held > 64 * chunk or len(rows) >= 1000:
                                yield pa.RecordBatch.from_pylist(rows, _OUT)
                                rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _OUT)

    # one file after the other to as many tasks as there are files
    parts = max(1, min(files.count(), files.sparkSession.sparkContext.defaultParallelism * 64))
    return files.select("path").repartition(parts).mapInArrow(read, CHUNK_SCHEMA)


def record_number(column: str) -> Column:
    """The id in a record's URI; null for the record without one."""
    return F.regexp_extract(column, r"<urn:record:(-?[0-9]+)>", 1).try_cast("long")


def archive_round_trip(spark: SparkSession, records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``records`` (``record_id`` long, ``target_uri``, ``payload`` binary) as archives and read their chunks.

    Null payloads are empty, null URIs become ``urn:none``; repeated rows are records of
    their own. An empty table gives no rows.
    """
    files = write_archives(chunked(with_revisits(records)), folder or work_dir(spark, "warc"))
    return read_chunks(files)
