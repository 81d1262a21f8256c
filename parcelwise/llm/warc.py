"""WARC archives of individually compressed records with an embedded Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import new_path, small_enough, store

#: The frame type of the dictionary (a fixed value of the format).
DICT_MAGIC = 0x184D2A5D
#: Records of an archive that its dictionary is built from, at most; the sample's bytes; the dictionary's.
SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES = 400, 1 << 20, 32 << 10
#: An archive is closed beyond so many compressed bytes.
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
#: Payloads with copies, up to so many, are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: str) -> str:
    """A header value without control characters or spaces."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the response's HTTP head, with the length of the full payload, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary of the records, or their last bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, records, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-DICT_BYTES:] or b"WARC/1.1\r\n"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


class Archive:
    """One archive file: the dictionary in a leading skippable frame, then a frame per record."""

    def __init__(self, uri: str, sample: list[bytes]):
        self.uri, self.size = uri, 0
        system, path = _opened(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        raw = build_dictionary(sample)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True).compress
        self._write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._write(self.compress(data))

    def close(self) -> None:
        self.out.close()


def read_archive(uri: str) -> Iterator[bytes]:
    """The records of an archive in order, one frame in memory at a time."""
    system, path = _opened(uri)
    with system.open_input_stream(path, compression=None, buffer_size=1 << 20) as stream:
        magic, size = struct.unpack("<II", stream.read(8))
        if magic != DICT_MAGIC:
            raise ValueError(f"{uri}: no dictionary frame")
        context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
        # Each frame is given to the decompressor in pieces; what it leaves over begins the next frame.
        rest, frame, out = b"", None, io.BytesIO()
        while True:
            data = rest or stream.read(1 << 16)
            rest = b""
            if not data:
                break
            frame = frame or context.decompressobj()
            out.write(frame.decompress(data))
            if frame.eof:
                yield out.getvalue()
                rest, frame, out = frame.unused_data, None, io.BytesIO()
        if frame is not None:
            raise ValueError(f"{uri}: the last record is cut off")


def parse(data: bytes) -> dict:
    """Fields of one record; a response's digest is computed from its payload and must equal the header's."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])

    def page(name: str) -> int | None:
        text = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"page {page('WARC-Record-ID')}: damaged payload")
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "payload": payload,
    }


def _digests(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    # Equal payloads are told by SHA-256; base 32 SHA-1 is made in the task that writes.
    return rows.withColumn("key", F.sha2("payload", 256))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes a record per row of ``pages`` and returns ``(archive, records, bytes)``.

    Among payloads of at least ``min_bytes`` that are equal, rows with the smallest page_id
    are responses (all of them, where a row is repeated) and the others revisit it; NULL ids
    count as largest, and copies without any id are responses. NULL html is an empty
    payload. Every task writes archives of its own under new names, and only those of tasks
    that succeeded are listed, so a lost executor leaves no half archive behind in the result.
    Html is not shuffled: only copied payloads' keys are, and they are joined back by broadcast
    while they are few. An empty table gives no archive; further columns are not read.
    """
    rows = _digests(pages, id_col, url_col, html_col)
    copied = rows.where(F.length("payload") >= min_bytes).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    copied = store(copied.where("n > 1 and first is not null").select("key", "first"), "copied")
    marked = rows.join(small_enough(copied, BROADCAST_ROWS), "key", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[bytes]) -> Archive:
            archive = Archive(f"{folder}/{uuid.uuid4().hex}.warc.zst", held)
            for data in held:
                archive.add(data)
            return archive

        def done(archive: Archive, n: int) -> pa.RecordBatch:
            archive.close()
            return pa.RecordBatch.from_arrays([pa.array([archive.uri]), pa.array([n], pa.int64()), pa.array([archive.size], pa.int64())], ["archive", "records", "bytes"])

        archive, held, held_bytes, n = None, [], 0, 0
        for batch in batches:
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = record(page_id, url, payload, payload_digest(payload), first)
                n += 1
                if archive is None:
                    held.append(data)
                    held_bytes += len(data)
                    if len(held) >= SAMPLE_RECORDS or held_bytes >= SAMPLE_BYTES:
                        archive, held, held_bytes = flush(held), [], 0
                else:
                    archive.add(data)
                if archive is not None and archive.size >= ARCHIVE_BYTES:
                    yield done(archive, n)
                    archive, n = None, 0
        if held:
            archive = flush(held)
        if archive is not None:
            yield done(archive, n)

    return store(marked.select("page_id", "url", "payload", refers.alias("refers_to")).mapInArrow(run, "archive string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the listed archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    kinds |= {"payload": pa.binary()} if payloads else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for data in read_archive(uri):
                    rows.append(parse(data))
                    held += len(data) if payloads else 200
                    if held >= 4 << 20:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    schema = ", ".join(f"{k} {names[t]}" for k, t in kinds.items())
    # A task of its own for every archive, whatever the number of rows of the list.
    listed = archives.select("archive").repartition(max(1, archives.count()), "archive")
    return listed.mapInArrow(run, schema)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads their records back."""
    return read_archives(write_archives(pages, new_path(pages.sparkSession, "warc"), min_bytes))
