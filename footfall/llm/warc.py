"""WARC records in seekable Zstandard bundles.

A bundle is one `.warc.zst` file: records grouped into frames that decompress on their own, then a skippable frame with the
seek table (sizes of every frame). An index maps record identifiers to a frame and the offset within it, so that one
record is read by decompressing one frame.

Bundles are rows of a table (name, bytes, index): Spark's writer commits them, so that a task that is run again leaves
neither halves nor doubles. `export` puts the bytes into files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored

LEAST_SHARED_PAYLOAD = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20

# Fixed values of the formats: seekable Zstandard, WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

_INDEX = "array<struct<record_id:string,frame:int,offset:long,length:long>>"
BUNDLE_SCHEMA = f"bundle string, data binary, index {_INDEX}"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page/{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit of the response of page `refers_to` without it."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = HTTP_HEAD.format(len(payload)).encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + " ".join((url or "about:blank").split()),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    block = head + payload if refers_to is None else head
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame at the end: compressed and decompressed size of every frame."""
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def frames(data: bytes) -> list[tuple[int, int, int]]:
    """Start, compressed and decompressed size of every frame, from the seek table alone."""
    count, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end")
    entries = struct.iter_unpack("<II", data[len(data) - 9 - 8 * count : -9])
    out, start = [], 0
    for packed, size in entries:
        out.append((start, packed, size))
        start += packed
    return out


def frame(data: bytes, number: int) -> bytes:
    """One frame, decompressed; nothing else is."""
    start, packed, size = frames(data)[number]
    return zstandard.ZstdDecompressor().decompress(data[start : start + packed], max_output_size=size)


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that begins at `at`."""
    stop = raw.index(b"\r\n\r\n", at)
    first, *lines = raw[at:stop].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines)
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    return headers, raw[begin:end], end + 4


class _Bundle:
    """Gathers records into frames, frames into one bundle."""

    def __init__(self) -> None:
        self.data, self.sizes, self.index = [], [], []
        self.records: list[bytes] = []
        self.length = self.packed = 0
        self.zstd = zstandard.ZstdCompressor(level=3)

    def add(self, name: str, raw: bytes) -> None:
        self.index.append({"record_id": name, "frame": len(self.sizes), "offset": self.length, "length": len(raw)})
        self.records.append(raw)
        self.length += len(raw)
        if self.length >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.records:
            packed = self.zstd.compress(b"".join(self.records))
            self.data.append(packed)
            self.sizes.append((len(packed), self.length))
            self.packed += len(packed)
            self.records, self.length = [], 0

    def row(self, name: str) -> pa.RecordBatch:
        self.close_frame()
        kind = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
        data = b"".join(self.data) + seek_table(self.sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([data], pa.binary()), pa.array([self.index], kind)], names=["bundle", "data", "index"]
        )


def with_revisits(rows: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads of at least LEAST_SHARED_PAYLOAD bytes the largest page_id is
    referred to by the others. Payloads are equal when their SHA-256 and length are."""
    pages = rows.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
    )
    sized = F.octet_length("html")
    # Short payloads get no key and so meet nothing.
    key = F.when(sized >= LEAST_SHARED_PAYLOAD, F.concat_ws("-", F.sha2("html", 256), sized))
    pages = pages.withColumn("key", key)
    groups = (
        pages.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("key").alias("shared"), "keep")
    )
    return pages.join(groups, F.col("key") == F.col("shared"), "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep")).alias("refers_to")
    )


def bundles(rows: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Bundles of the records of (page_id, url, html, refers_to): bundle, data, index.

    A bundle is closed at BUNDLE_BYTES, so that a task holds no more than that and one record.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, bundle = TaskContext.get().partitionId(), 0, _Bundle()
        for batch in batches:
            for page, url, html, refers in zip(*batch.columns, strict=True):
                page_id = page.as_py()
                payload = (html.as_py() or "").encode()
                bundle.add(record_id(page_id), record(page_id, url.as_py(), payload, refers.as_py(), date))
                if bundle.packed >= BUNDLE_BYTES:
                    yield bundle.row(f"part-{part:06d}-{number:04d}.warc.zst")
                    number, bundle = number + 1, _Bundle()
        if bundle.index:
            yield bundle.row(f"part-{part:06d}-{number:04d}.warc.zst")

    return rows.select("page_id", "url", "html", "refers_to").mapInArrow(write, BUNDLE_SCHEMA)


def records(archive: DataFrame) -> DataFrame:
    """Every record of the bundles: page_id, record_type, payload_bytes, payload_digest (hex), refers_to, bundle.

    Payloads of responses are digested anew and held against their header; a revisit has no payload, its bytes are null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                raw = data.as_py()
                for number in range(len(frames(raw))):
                    piece, at = frame(raw, number), 0
                    while at < len(piece):
                        headers, block, at = parse(piece, at)
                        rows.append(_described(headers, block) | {"bundle": bundle})
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    kind = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("bundle", pa.string())]
    )
    schema = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, bundle string"
    return archive.select("bundle", "data").mapInArrow(read, schema)


def _described(headers: dict[str, str], block: bytes) -> dict:
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    response = headers["WARC-Type"] == "response"
    if response and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    return {
        "page_id": None if page is None else int(page),
        "record_type": headers["WARC-Type"],
        "payload_bytes": len(payload) if response else None,
        "payload_digest": digest,
        "refers_to": None if refers is None else int(refers),
    }


def look_up(archive: DataFrame, wanted: DataFrame) -> DataFrame:
    """(record_id, record): the raw records of the identifiers in column record_id of `wanted`.

    The index says which frames of which bundles are needed; only those are decompressed.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, places in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw, opened = data.as_py(), {}
                for place in sorted(places, key=lambda x: (x["frame"], x["offset"])):
                    if place["frame"] not in opened:
                        opened = {place["frame"]: frame(raw, place["frame"])}
                    piece = opened[place["frame"]][place["offset"] : place["offset"] + place["length"]]
                    yield pa.RecordBatch.from_arrays([pa.array([place["record_id"]]), pa.array([piece], pa.binary())], names=["record_id", "record"])

    index = archive.select("bundle", F.inline("index"))
    found = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi").groupBy("bundle").agg(
        F.collect_list(F.struct("record_id", "frame", "offset", "length")).alias("places")
    )
    return archive.select("bundle", "data").join(found, "bundle").select("data", "places").mapInArrow(read, "record_id string, record binary")


def export(archive: DataFrame, folder: str) -> None:
    """Write every bundle as a file of its name into `folder`, a URI that all executors reach. May be repeated."""

    def put(rows: Iterable) -> None:
        store, path = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(path)
        for row in rows:
            # The file gets its name when it is whole.
            draft = f"{path}/.{row['bundle']}-{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(bytes(row["data"]))
            store.move(draft, f"{path}/{row['bundle']}")

    archive.select("bundle", "data").foreachPartition(put)


def archived(rows: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Write a record for every row, read the archive back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload, a null url `about:blank`. Rows that repeat a page_id get a record each; if that id is the
    largest of its payload, each is a response. Null ids never win. An empty table gives no rows.
    """
    archive = stored(bundles(with_revisits(rows, id_column, url_column, html_column)))
    found = records(archive)
    responses = (
        found.filter("record_type = 'response'")
        .groupBy(F.col("page_id").alias("response_id"), F.col("payload_digest").alias("response_digest"))
        .agg(F.max("payload_bytes").alias("response_bytes"))
    )
    same = (F.col("refers_to") == F.col("response_id")) & (F.col("payload_digest") == F.col("response_digest"))
    return found.join(responses, same, "left").select(
        "page_id",
        F.coalesce("payload_bytes", "response_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
