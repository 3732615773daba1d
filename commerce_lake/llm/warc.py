"""WARC records in seekable Zstandard bundles.

A task writes its records to bundles in the shared folder. A bundle is a row of independent
frames, each with whole records, and ends with a seek table that gives the size of every frame
(the public seekable format). The index, a table, maps a record to bundle, frame and offset in
the frame; it names only what a committed task wrote, so a repeated task leaves no double records.
"""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import slices, stored
from commerce_lake.session import work_dir

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 256 * 1024 * 1024
RUN_FRAMES = 16
TASK_BYTES = 16 * 1024 * 1024
REVISIT_BYTES = 1000
# Fixed values of the seekable format: magic numbers of the skippable frame and of its footer.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "page_id long, bundle string, frame int, offset long, bytes long"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path in it; a path without scheme is a mounted folder."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer for frames of (compressed, plain) bytes."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    body = entries + struct.pack("<IBI", len(sizes), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def read_seek_table(source: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(start, compressed, plain bytes) of each frame, from the end of a bundle."""
    end = source.size()
    source.seek(end - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != _SEEKABLE:
        raise ValueError("the bundle has no seek table")
    width = 12 if flags & 0x80 else 8
    source.seek(end - 9 - count * width)
    entries = source.read(count * width)
    out, start = [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", entries, k * width)
        out.append((start, packed, plain))
        start += packed
    return out


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: the response, or a revisit of the response of another page."""
    body = _HTTP + (b"" if refers_to is not None else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        "WARC-Date: 1970-01-01T00:00:00Z",  # the table has no crawl time
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, names in lower case, and the content of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the record does not end where it says")
    return fields, rest[:size]


class BundleWriter:
    """Writes records to one bundle after another, and says where each went."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES):
        self.fs, self.path = file_system(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.folder, self.frame_bytes, self.bundle_bytes = folder.rstrip("/"), frame_bytes, bundle_bytes
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.sink, self.frame, self.filled, self.sizes, self.written = None, [], 0, [], 0

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        """(bundle, frame, offset in the frame, bytes) of the record."""
        if self.sink is None:
            self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
            self.sink = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        place = (f"{self.folder}/{self.name}", len(self.sizes), self.filled, len(record))
        self.frame.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self._end_frame()
            if self.written >= self.bundle_bytes:
                self.close()
        return place

    def _end_frame(self) -> None:
        packed = self.packer.compress(b"".join(self.frame))
        self.sink.write(packed)
        self.sizes.append((len(packed), self.filled))
        self.written += len(packed)
        self.frame, self.filled = [], 0

    def close(self) -> None:
        if self.sink is None:
            return
        if self.frame:
            self._end_frame()
        self.sink.write(seek_table(self.sizes))
        self.sink.close()
        self.sink, self.sizes, self.written = None, [], 0


def write_bundles(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Writes a record for each row of `df`; returns the stored index (page_id, bundle, frame, offset, bytes).

    Of pages with equal payloads of `revisit_bytes` or more, that with the largest id is written
    in full and the others name it. A missing payload is empty, a missing id stays missing; rows
    repeated with the largest id are all written in full. Other columns are ignored.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    pages = df.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"), F.sha2(payload, 256).alias("sha")
    )
    # one row for each payload that stands twice or more
    equal = (
        pages.where(F.octet_length("payload") >= revisit_bytes)
        .groupBy("sha")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("target"))
        .where("n > 1")
    )
    equal = stored(equal.select("sha", "target"), "warc_equal")
    revisit = F.when((F.col("target") > F.coalesce("page_id", F.lit(-1 << 63))), F.col("target"))
    records = pages.join(equal, "sha", "left").select("page_id", "url", "payload", "digest", revisit.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder)
        for batch in slices(batches):
            rows = zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "digest", "refers_to")))
            places = [writer.add(record_bytes(p, u, t.encode("utf-8", "surrogatepass"), d, r)) for p, u, t, d, r in rows]
            bundle, frame, offset, size = zip(*places)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bundle, pa.string()), pa.array(frame, pa.int32()), pa.array(offset, pa.int64()), pa.array(size, pa.int64())],
                ["page_id", "bundle", "frame", "offset", "bytes"],
            )
        writer.close()

    return stored(records.mapInArrow(write, _INDEX), "warc_index")


class BundleReader:
    """Reads single frames of bundles; keeps the open bundle and its seek table."""

    def __init__(self):
        self.bundle = None
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, bundle: str, number: int) -> bytes:
        if bundle != self.bundle:
            fs, path = file_system(bundle)
            self.source = fs.open_input_file(path)
            self.table, self.bundle = read_seek_table(self.source), bundle
        start, packed, plain = self.table[number]
        self.source.seek(start)
        data = self.unpacker.decompress(self.source.read(packed), max_output_size=plain)
        if len(data) != plain:
            raise ValueError("the frame is shorter than its seek table says")
        return data


def _page(reference: str) -> int | None:
    return int(number) if (number := reference.removeprefix("<urn:page:").removesuffix(">")) else None


def read_bundles(index: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of each record in the index.

    A frame is read and unpacked once, whichever of its records the index names. Runs of
    neighbouring frames are dealt over a task for each `task_bytes` of records, as the small rows of the
    index say nothing about the bytes behind them. The digest of a response is taken from its
    content and held against its header.
    """
    size = index.agg(F.sum("bytes")).first()[0] or 0
    runs = index.withColumn("run", F.floor(F.col("frame") / RUN_FRAMES)).repartition(size // task_bytes + 1, "bundle", "run")
    records = F.sort_array(F.collect_list(F.struct("offset", "bytes"))).alias("records")
    frames = runs.groupBy("bundle", "run", "frame").agg(records).drop("run").sortWithinPartitions("bundle", "frame")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = BundleReader()
        for batch in slices(batches, 64):
            out = []
            for bundle, frame, records in zip(*(c.to_pylist() for c in batch.columns)):
                data = reader.frame(bundle, frame)
                for r in records:
                    fields, content = parse_record(data[r["offset"] : r["offset"] + r["bytes"]])
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    kind, size = fields["warc-type"], int(fields["x-payload-length"])
                    if kind == "response":
                        payload = content.partition(b"\r\n\r\n")[2]
                        if (sha1(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError("a payload differs from its digest")
                    out.append((_page(fields["warc-record-id"]), fields["warc-target-uri"], size, digest, kind, _page(fields.get("warc-refers-to", ""))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _NAMES)

    return frames.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def round_trip(df: DataFrame) -> DataFrame:
    """Writes the pages to bundles in the shared folder and reads them all back."""
    return read_bundles(write_bundles(df, work_dir(df.sparkSession, "warc")))
