"""WARC archives in seekable Zstandard bundles.

Records are gathered into frames that are compressed each on its own; a bundle ends with the seek
table of the seekable Zstandard format, a skippable frame that any Zstandard reader passes over.
The index maps each record to its bundle, frame, and place within the frame, so that one record
is read by one seek and one frame's decompression.

Records with equal payloads of ``least_bytes`` and more keep one response, the one of the largest
id; the others become revisits that refer to it. The largest id of each digest is an aggregate
every task computes first; payloads are shuffled once, to meet it, by a join that adaptive
execution splits where one payload holds most rows. Short payloads get a key of their own each.

A task writes bundles under names of its own, so a task that runs again leaves no doubt which
files count: the index, written by Spark, names them. Bundles are written through pyarrow's file
systems; the folder must be one that they know (local, S3, GCS, HDFS).

Record ids hold the page's id, escaped, and a number of the row, so that rows that repeat an id have
records of their own; a revisit refers to one of those that hold the payload.

Defined results: a null payload is empty; a record without id is a revisit of a longer-lived id
where one exists, else a response; rows that repeat the largest id are all responses; a null url
is left out of its record; ids of any text, the empty one too, come back as they are; payloads of any
length are written whole; an empty table gives an empty archive. Further columns are not read.
"""

from __future__ import annotations

import math
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrail.llm.common import shared_folder, written

#: Numbers of the seekable format: the skippable frame, the end of the seek table, and its size.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FOOTER_BYTES = 9
FRAME_BYTES = 512 << 10
BUNDLE_BYTES = 256 << 20
LEVEL = 3
#: Bytes of records that a task reads back.
READ_BYTES = 64 << 20
#: The profile that the WARC standard gives to revisits of the same payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id string, bundle string, frame int, offset int, length int"
RECORD = (
    "page_id string, url string, record_type string, refers_to string, payload_bytes long, "
    "payload_digest string, payload binary"
)


class BundleWriter:
    """One bundle; gives each record's frame and place."""

    def __init__(self, folder: str):
        self.path = f"{folder}/part-{uuid.uuid4().hex}.warc.zst"
        system, path = FileSystem.from_uri(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = self.bytes = 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.open_bytes and self.open_bytes + len(record) > FRAME_BYTES:
            self._end_frame()
        at = len(self.frames), self.open_bytes
        self.open.append(record)
        self.open_bytes += len(record)
        return at

    def _end_frame(self) -> None:
        data = self.compressor.compress(b"".join(self.open))
        self.out.write(data)
        self.frames.append((len(data), self.open_bytes))
        self.bytes += len(data)
        self.open, self.open_bytes = [], 0

    def close(self) -> None:
        if self.open:
            self._end_frame()
        entries = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        table = entries + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of one bundle, by its seek table."""

    def __init__(self, uri: str):
        system, path = FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        entries = self.file.read_at(8 * n, size - FOOTER_BYTES - 8 * n)
        self.places, at = [], 0
        for stored, length in struct.iter_unpack("<II", entries):
            self.places.append((at, stored, length))
            at += stored
        self.last: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.last[0] != number:
            at, stored, length = self.places[number]
            data = zstandard.ZstdDecompressor().decompress(self.file.read_at(stored, at), max_output_size=length)
            self.last = number, data
        return self.last[1]


def record_urn(page_id: str | None, row: int) -> str:
    return f"<urn:row:{row}>" if page_id is None else f"<urn:page:{quote(page_id, safe='')}:{row}>"


def page_of_urn(urn: str) -> str | None:
    kind, _, rest = urn[len("<urn:"):-1].partition(":")
    return unquote(rest.rpartition(":")[0]) if kind == "page" else None


def record_bytes(page_id, row: int, url, payload: bytes | None, n: int, digest: str, refers_to, refers_row, date: str) -> bytes:
    """A WARC/1.1 record; one that refers to another keeps the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http if refers_to is not None else http + (payload or b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_urn(page_id, row)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_urn(refers_to, refers_row)), ("WARC-Profile", SAME_PAYLOAD)]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """What a record says, and its payload (none for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    page = lambda field: page_of_urn(fields[field]) if field in fields else None
    return {
        "page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
        "payload_bytes": int(stated["Content-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """Each page with size and digest of its payload, and the id it refers to; revisits lose the payload."""
    plain = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"),
        F.coalesce(pages[payload_col], F.lit("")).alias("payload"), F.monotonically_increasing_id().alias("row"),
    ).select(
        "*", F.octet_length("payload").cast("long").alias("n"), F.sha1(F.col("payload").cast("binary")).alias("digest"),
    )
    first = plain.where(F.col("n") >= least_bytes).groupBy("digest", "n").agg(
        F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "row"))).alias("first"), F.count("*").alias("copies")
    ).where("copies > 1 AND first IS NOT NULL").select(
        F.col("digest").alias("key"), F.col("n").alias("key_n"),
        F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"),
    )
    alone = F.concat(F.lit("short-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    keyed = plain.withColumn("own_key", F.when(F.col("n") >= least_bytes, F.col("digest")).otherwise(alone))
    joined = keyed.join(first, (keyed["own_key"] == first["key"]) & (keyed["n"] == first["key_n"]), "left")
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        F.col("page_id").cast("string").alias("page_id"), "row", "url", "n", "digest",
        F.when(~revisits, F.col("payload")).alias("payload"),
        F.when(revisits, F.col("first_id").cast("string")).alias("refers_to"), "first_row",
    )


def write_archives(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html", least_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes the bundles and returns their index, itself written: ``page_id`` (as text),
    ``bundle``, ``frame``, ``offset``, ``length``. The folder is a new shared one if not given.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if bundle is None:
                    bundle = BundleWriter(folder)
                payload = None if r["payload"] is None else r["payload"].encode()
                record = record_bytes(
                    r["page_id"], r["row"], r["url"], payload, r["n"], r["digest"], r["refers_to"], r["first_row"], date
                )
                rows.append((r["page_id"], bundle.path, *bundle.add(record), len(record)))
                if bundle.bytes >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["page_id", "bundle", "frame", "offset", "length"]
            )
        if bundle is not None:
            bundle.close()

    records = plan_records(pages, id_col, url_col, payload_col, least_bytes)
    return written(records.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records of the given rows of an index: ids, url, type, size, digest and payload.

    A payload whose digest is not the stated one ends the job.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        uri, reader = None, None
        for batch in batches:
            found, size = [], 0
            for r in batch.to_pylist():
                if r["bundle"] != uri:
                    uri, reader = r["bundle"], BundleReader(r["bundle"])
                data = reader.frame(r["frame"])[r["offset"]:r["offset"] + r["length"]]
                record = parse_record(data)
                payload = record["payload"]
                if payload is not None and hashlib.sha1(payload).hexdigest() != record["payload_digest"]:
                    raise ValueError(f"record {record['page_id']} of {uri} is damaged")
                found.append(record)
                size += len(payload or b"")
                if size > 8 << 20:
                    yield from _record_batches(found)
                    found, size = [], 0
            yield from _record_batches(found)

    order = ("bundle", "frame", "offset")
    # As many tasks as the records' bytes ask for: the index itself is small.
    size = index.agg(F.sum(F.col("length").cast("long"))).first()[0] or 0
    sought = index.repartition(max(1, math.ceil(size / READ_BYTES)), "bundle", "frame").sortWithinPartitions(*order)
    return sought.mapInArrow(read, RECORD)


def _record_batches(found: list[dict]) -> list[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])
    return pa.Table.from_pylist(found, schema).to_batches()
