"""WARC records in seekable Zstandard bundles.

A bundle is a byte string of independent Zstandard frames, each holding whole WARC records, and a seek table in a
skippable frame at its end (the public seekable format), so any Zstandard reader can read it through and a seeking one
can open a single frame. Bundles and the map from record to (bundle, frame, offset in the frame) are the two parts of
one Parquet table, so they can be written to whatever store Spark writes to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, shared_dir, tidied, with_maybe, written

#: Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 8 << 20
#: Parts that the pages of one payload are dealt over when they look up the first of them.
SALTS = 64
SCHEMA = "bundle string, data binary, records array<struct<record_id: long, frame: int, offset: long, length: long>>"


def record_uri(page_id: int) -> str:
    return f"urn:uuid:{uuid.UUID(int=page_id % (1 << 64))}"


def page_of(uri: str) -> int:
    n = uuid.UUID(uri.strip("<>").removeprefix("urn:uuid:")).int
    return n - (1 << 64) if n >> 63 else n


def warc_record(page_id: int, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit has the HTTP head, which tells the payload's size, but not the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_uri(page_id)}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: <{record_uri(refers_to)}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, bytes, int]:
    """(WARC fields, HTTP head, payload, where the next record starts) of the record at a place."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    end = stop + 4 + int(fields["Content-Length"])
    http, _, payload = data[stop + 4 : end].partition(b"\r\n\r\n")
    return fields, http, payload, end + 4


class Bundle:
    """Records are added one by one; close() gives the bundle's bytes and its records' places."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes, self.frames, self.sizes, self.records = frame_bytes, [], [], []
        self.open, self.size, self.done = [], 0, 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, record_id: int, record: bytes) -> None:
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        self.records.append({"record_id": record_id, "frame": len(self.frames), "offset": self.size, "length": len(record)})
        self.open.append(record)
        self.size += len(record)

    def flush(self) -> None:
        if self.open:
            frame = self.compressor.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.size))
            self.done += len(frame)
            self.open, self.size = [], 0

    def close(self) -> tuple[bytes, list[dict]]:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEK_MAGIC)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer, self.records


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the footer alone."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    out, at = [], 0
    for k in range(n):
        packed, size = struct.unpack_from("<II", data, len(data) - 9 - width * (n - k))
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(data: bytes, frame: int) -> bytes:
    at, packed, size = seek_table(data)[frame]
    return zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=size)


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) with payload, size, sha1 and refers_to: of equal payloads of least_bytes or more, all but the
    smallest page_id refer to that. Equal means equal SHA-256. Null html is empty; rows without a page_id are left out;
    a page_id that comes twice gives two records; other columns are not read.

    Pages of one payload only meet as ids and digests, dealt over SALTS parts; payloads that occur once aren't shuffled at all,
    the others by page.
    """
    folder = shared_dir(pages.sparkSession)
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.filter("page_id IS NOT NULL").select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "sha256": F.unhex(F.sha2("payload", 256))})
    narrow = rows.filter(F.col("size") >= least_bytes).select("page_id", "sha256")
    groups = narrow.groupBy("sha256").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last").select("sha256", "first")
    groups = written(groups, folder, "groups")
    repeated = bit_filter(groups, "sha256")
    salted = with_maybe(narrow, repeated, "sha256", "_hit").filter("_hit").withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    firsts = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    refers = written(salted.join(firsts, ["sha256", "_salt"]).filter("page_id > first").select("page_id", "sha256", "first").distinct(), folder, "refers")
    marked = with_maybe(rows, repeated, "sha256", "_hit")
    joined = marked.filter("_hit").join(refers, ["page_id", "sha256"], "left")
    out = joined.unionByName(marked.filter("NOT _hit").withColumn("first", F.lit(None).cast("long")))
    return out.select("page_id", "url", "size", "sha1", F.col("first").alias("refers_to"), F.when(F.col("first").isNull(), F.col("payload")).alias("payload"))


def bundles(pages: DataFrame, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """The pages as bundles: bundle (a name), data, records (where each record lies). Each task bundles the rows that it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, bundle, part = 0, Bundle(frame_bytes), TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            data, records = bundle.close()
            return pa.RecordBatch.from_pylist([{"bundle": f"{part:06d}-{made:05d}.warc.zst", "data": data, "records": records}], schema)

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, size, sha1, refers_to, payload = (c[i].as_py() for c in batch.columns)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                bundle.add(page_id, warc_record(page_id, url, payload or b"", size, digest, refers_to, date))
                if bundle.done >= bundle_bytes:
                    yield close()
                    made, bundle = made + 1, Bundle(frame_bytes)
        if bundle.records:
            yield close()

    schema = pa.schema([("bundle", pa.string()), ("data", pa.binary()), ("records", pa.list_(pa.struct([("record_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])))])
    return with_references(pages, least_bytes).mapInArrow(tidied(run), SCHEMA)


def index(bundled: DataFrame) -> DataFrame:
    """record_id, bundle, frame, offset, length of every record."""
    return bundled.select("bundle", F.inline("records")).select("record_id", "bundle", "frame", "offset", "length")


def read(bundled: DataFrame) -> DataFrame:
    """Every record of the bundles, frame by frame: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A response whose payload doesn't fit its digest or its length is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column(0)[k].as_py()
                for at, packed, size in seek_table(data):
                    frame, place, rows = unpack.decompress(data[at : at + packed], max_output_size=size), 0, []
                    while place < size:
                        fields, http, payload, place = parse_record(frame, place)
                        n = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                        digest, refers = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("WARC-Refers-To")
                        if refers is None and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
                        rows.append((page_of(fields["WARC-Record-ID"]), n, digest, fields["WARC-Type"], refers and page_of(refers), fields.get("WARC-Target-URI")))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return bundled.select("data").mapInArrow(tidied(run), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def fetch(bundled: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted (record_id) records' bytes: each is cut out of the one frame that holds it.

    Each bundle with a wanted record goes to one task once, with the places of its records; a frame is unpacked once. Bundles without one
    aren't shuffled. Ids that aren't there or are null give no row.
    """
    places = index(bundled).join(wanted.select(F.col("record_id").cast("long")).distinct(), "record_id", "left_semi")
    places = places.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("frame", "offset", "length", "record_id"))).alias("places"))
    places = written(places, shared_dir(bundled.sparkSession), "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, open_frame, frame = batch.column(0)[k].as_buffer().to_pybytes(), None, b""
                ids, records = [], []
                for place in batch.column(1)[k].as_py():
                    if place["frame"] != open_frame:
                        open_frame, frame = place["frame"], read_frame(data, place["frame"])
                    ids.append(place["record_id"])
                    records.append(frame[place["offset"] : place["offset"] + place["length"]])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(records, pa.binary())], ["record_id", "record"])

    needed = with_maybe(bundled.select("bundle", "data"), bit_filter(places, "bundle"), "bundle", "_hit").filter("_hit")
    return needed.join(places, "bundle").select("data", "places").mapInArrow(tidied(cut), "record_id long, record binary")
