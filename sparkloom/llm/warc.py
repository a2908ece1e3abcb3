"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress independently; a bundle ends
with the seek table of the Zstandard seekable format (a skippable frame), and an
index maps each record's identifier to its frame and the offset within it, so
one record is read by decompressing one frame. Records with equal payloads are
written once: the one with the largest page id is the response, the others are
revisits that refer to it.

Bundles are a table (bundle_id, archive, index): any store that Spark writes
can hold them, and a lost task is simply run again. ``export`` lays the
archives out as files.

Defined cases: a null payload is empty; a null URL is written as a URN; rows
that repeat both the largest page id and the payload are all responses; where
all equal payloads lack a page id all are responses; payloads are matched by
digest; an empty table gives no bundles; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.scratch import cut

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES = 512 << 10, 4 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
SCHEMA = "bundle_id string, archive binary, index array<struct<record_id: string, page_id: bigint, frame: int, offset: bigint>>"


def decide(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, refers_to``; refers_to is null for responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.encode(payload_col, "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    copies = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1 and kept is not null")
    kept = cut(copies.select("digest", "kept"), "kept")
    joined = rows.join(kept, "digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("kept")).alias("refers_to"))


def record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest.hex()}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> tuple[str, bytes]:
    """Identifier and bytes of one WARC record."""
    me = record_id(page_id, digest)
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {me}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}", "Content-Type: application/http;msgtype=response",
    ]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    block = HTTP + payload
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page: {refers_to}", f"Full-Payload-Length: {len(payload)}"]
        block = HTTP
    head.append(f"Content-Length: {len(block)}")
    return me, "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """One archive as it grows."""

    def __init__(self):
        self.out, self.frame, self.table, self.index = io.BytesIO(), io.BytesIO(), [], []
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, page_id: int | None, name: str, raw: bytes) -> None:
        self.index.append({"record_id": name, "page_id": page_id, "frame": len(self.table), "offset": self.frame.tell()})
        self.frame.write(raw)
        if self.frame.tell() >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.frame.tell():
            packed = self.zstd.compress(self.frame.getvalue())
            self.table.append((len(packed), self.frame.tell()))
            self.out.write(packed)
            self.frame = io.BytesIO()

    def close(self) -> bytes:
        self.end_frame()
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = entries + struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(footer)) + footer)
        return self.out.getvalue()


def write(records: DataFrame) -> DataFrame:
    """Bundles of the records that ``decide`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle()
        for b in batches:
            for row in zip(*(b.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                page_id, *more = (x.as_py() for x in row)
                bundle.add(page_id, *record(page_id, *more))
                if bundle.out.tell() >= BUNDLE_BYTES:
                    yield _row(bundle)
                    bundle = Bundle()
        if bundle.index:
            yield _row(bundle)

    return records.mapInArrow(run, SCHEMA)


def _row(bundle: Bundle) -> pa.RecordBatch:
    raw = bundle.close()
    name = hashlib.sha256(raw).hexdigest()[:32]
    kind = pa.list_(pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([raw], pa.binary()), pa.array([bundle.index], kind)], names=["bundle_id", "archive", "index"])


def seek_table(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of each frame, from the archive's end."""
    n, flags, magic = struct.unpack("<IBI", raw[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at = len(raw) - 9 - n * width
    if struct.unpack("<II", raw[at - 8 : at]) != (SKIPPABLE, n * width + 9):
        raise ValueError("damaged seek table")
    found, start = [], 0
    for i in range(n):
        packed, size = struct.unpack("<II", raw[at + i * width : at + i * width + 8])
        found.append((start, packed, size))
        start += packed
    return found


def frame(raw: bytes, k: int, table: list[tuple[int, int, int]] | None = None) -> bytes:
    start, packed, size = (table or seek_table(raw))[k]
    out = zstandard.ZstdDecompressor().decompress(raw[start : start + packed], max_output_size=size)
    if len(out) != size:
        raise ValueError("a frame's size differs from the seek table")
    return out


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and end of the record at an offset."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("no WARC record starts here")
    fields = dict(x.split(": ", 1) for x in lines)
    stop = end + 4 + int(fields["Content-Length"])
    return fields, data[end + 4 : stop], stop + 4


def fetch(raw: bytes, k: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its place in the index; only its frame is decompressed."""
    return parse(frame(raw, k), offset)[:2]


def described(fields: dict[str, str], block: bytes) -> tuple[int | None, int, str, str, int | None]:
    """Page id, payload size and digest, record type and the page referred to; the payload of a response is digested anew."""
    page_id = int(fields["Page-Id"]) if "Page-Id" in fields else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "revisit":
        return page_id, int(fields["Full-Payload-Length"]), digest, "revisit", int(fields["Refers-To-Page"])
    payload = block[len(HTTP) :]
    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return page_id, len(payload), digest, "response", None


def read(bundles: DataFrame) -> DataFrame:
    """One row per record of all archives, each checked against the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            for raw, index in zip(b.column("archive"), b.column("index"), strict=True):
                raw, places, rows = raw.as_py(), iter(index.as_py()), []
                table = seek_table(raw)
                for k in range(len(table)):
                    data, at = frame(raw, k, table), 0
                    while at < len(data):
                        place, (fields, block, after) = next(places), parse(data, at)
                        if (place["record_id"], place["frame"], place["offset"]) != (fields["WARC-Record-ID"], k, at):
                            raise ValueError("the index doesn't match the archive")
                        rows.append(described(fields, block))
                        at = after
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return bundles.select("archive", "index").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def export(bundles: DataFrame, folder: str) -> DataFrame:
    """Write each archive as ``folder/<bundle_id>.warc.zst`` in a store that all executors reach; the files' names and sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for b in batches:
            names, sizes = [], []
            for name, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_output_stream(f"{base}/{name}.warc.zst", compression=None) as out:
                    out.write(raw)
                names.append(f"{name}.warc.zst")
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["file", "bytes"])

    return bundles.select("bundle_id", "archive").mapInArrow(run, "file string, bytes long")


def archive_pages(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Bundles of all pages, written to the scratch store and read from there."""
    return cut(write(decide(pages, min_bytes, id_col, url_col, payload_col)), "bundles")
