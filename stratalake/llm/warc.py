"""WARC archives as seekable Zstandard bundles.

A task writes the records of its rows into bundle files: some records at a time form one independent Zstandard frame, and
the bundle ends in a skippable frame with the compressed and the plain size of each frame (the seekable format). The
index maps each record's identifier to bundle, frame and offset in the plain frame, so one record is read by decompressing
one frame. Of pages with equal payloads the one with the smallest id is a response record, all others are revisit
records, which name it and carry no payload; equal payloads are found by digest, with one row per digest and task before
the shuffle.

Files have names that no other attempt uses, and only those named in the index, which Spark commits as a table, are ever
read: a task that runs twice leaves an unused file, no double record.

Defined results: a null payload is an empty one; a null URL leaves out the target header; rows with a null id never
become the response of others while an id is there, and are written with an empty identifier; rows that repeat the
smallest id are responses, too; payloads of any length are written whole, each in one frame; control characters and spaces of a URL are percent-encoded; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.functions.names import column
from stratalake.llm.common import written
from stratalake.sources.storage import shared_dir

#: Plain bytes of a frame and compressed bytes of a bundle, at which the next one starts.
FRAME, BUNDLE = 1 << 19, 1 << 26
LEVEL = 3
#: Frames of a bundle that are read together, and such runs in a partition.
RUN, RUNS = 8, 2
#: Fixed values of the seekable Zstandard format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
IDENTIFIER = "<urn:x-page:{}>"


def opened(folder: str):
    """The file system of a folder, and its path there."""
    from pyarrow import fs

    if re.match(r"file:/[^/]", folder):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def record(page: str | None, url: str | None, payload: bytes | None, size: int, sha1: bytes, refers_to: str | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    name = IDENTIFIER.format(quote(page or "", safe=""))
    head = ["WARC/1.1", "WARC-Type: " + ("response" if refers_to is None else "revisit"), "WARC-Record-ID: " + name]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: quote(m[0]), url))
    head += ["WARC-Date: 1970-01-01T00:00:00Z", "WARC-Payload-Digest: sha1:" + base64.b32encode(sha1).decode()]
    if refers_to is not None:
        payload = b""
        head += ["WARC-Refers-To: " + IDENTIFIER.format(quote(refers_to, safe="")), "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at an offset of a plain frame, as a dict, and the offset after it."""
    end = data.index(b"\r\n\r\n", at)
    head = dict(line.split(": ", 1) for line in data[at:end].decode("utf-8").split("\r\n")[1:])
    start, size = end + 4, int(head["Content-Length"])
    body = data.index(b"\r\n\r\n", start) + 4
    length = int(re.search(rb"\r\nContent-Length: (\d+)", data[start:body])[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = data[body : start + size]
    if head["WARC-Type"] == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{head['WARC-Record-ID']}: the payload does not have the stated size and digest")
    name = lambda field: unquote(head[field][len("<urn:x-page:") : -1]) or None
    out = {"page": name("WARC-Record-ID"), "url": head.get("WARC-Target-URI"), "type": head["WARC-Type"], "digest": digest, "size": length}
    out |= {"refers_to": name("WARC-Refers-To") if "WARC-Refers-To" in head else None, "payload": payload}
    return out, start + size + 4


class BundleWriter:
    """One bundle file; ``add`` gives the frame and the offset of a record in it."""

    def __init__(self, files, path: str):
        import zstandard

        self.coder = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.path, self.stream = path, files.open_output_stream(path, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.plain = self.size = 0

    def add(self, data: bytes) -> tuple[int, int]:
        place = len(self.frames), self.plain
        self.open.append(data)
        self.plain += len(data)
        if self.plain >= FRAME:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.open:
            packed = self.coder.compress(b"".join(self.open))
            self.stream.write(packed)
            self.frames.append((len(packed), self.plain))
            self.size += len(packed)
            self.open, self.plain = [], 0

    def close(self) -> None:
        self.end_frame()
        self.stream.write(seek_table(self.frames))
        self.stream.close()


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, files, path: str):
        import zstandard

        self.coder, self.file = zstandard.ZstdDecompressor(), files.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.places, at = [], 0
        for packed, plain in sizes:
            self.places.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.places[number]
        self.file.seek(at)
        return self.coder.decompress(self.file.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes all rows as records into bundles below ``folder``, once the result is computed: the index
    ``page_id, bundle, frame, offset``. Compute it once (write it), since each computation writes bundles."""
    chosen = pages.select(column(id_col).alias("page_id"), column(url_col).cast("string").alias("url"), F.coalesce(column(payload_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    chosen = chosen.select("page_id", "url", "payload", F.octet_length("payload").alias("size"), F.unhex(F.sha1("payload")).alias("sha1"))
    # only digests that more rows share are joined back
    first = chosen.filter(F.col("size") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha1", "first")
    known = chosen.join(first, "sha1", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("size") >= least_bytes)
    known = known.withColumn("refers_to", F.when(again, F.col("first").cast("string")))
    known = known.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "sha1", "refers_to")
    names = ["page_id", "bundle", "frame", "offset"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        files.create_dir(root, recursive=True)
        out = None
        for batch in batches:
            bundles, frames, offsets = [], [], []
            for page, url, payload, size, sha1, refers_to in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if out is None:
                    out = BundleWriter(files, f"{root}/{uuid.uuid4().hex}.warc.zst")
                frame, offset = out.add(record(None if page is None else str(page), url, payload, size, sha1, refers_to))
                bundles.append(out.path.rsplit("/", 1)[1])
                frames.append(frame)
                offsets.append(offset)
                if out.size >= BUNDLE:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bundles, pa.string()), pa.array(frames, pa.int64()), pa.array(offsets, pa.int64())], names)
        if out is not None:
            out.close()

    kind = chosen.schema["page_id"].dataType.simpleString()
    return known.mapInArrow(write, f"page_id {kind}, bundle string, frame long, offset long")


def read_bundles(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """All records that an index names, each at its frame and offset: ``page, payload_bytes, payload_digest, record_type,
    refers_to`` (ids as text) and, if asked for, ``url`` and ``payload``.

    A row of work is a run of RUN frames of one bundle, and a partition has RUNS of them at most on average, however small
    the index is: their number follows the size of the archive.
    """
    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["url", "payload"] * with_payload
    fields = ["page", "size", "digest", "type", "refers_to"] + ["url", "payload"] * with_payload
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        for batch in batches:
            for bundle, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = BundleReader(files, f"{root}/{bundle}")
                for number, own in groupby(sorted((p["frame"], p["offset"]) for p in places), key=lambda p: p[0]):
                    data = reader.frame(number)
                    found = [parsed(data, offset)[0] for _, offset in own]
                    yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in zip(fields, kinds)], names)
                reader.close()

    schema = "page string, payload_bytes long, payload_digest string, record_type string, refers_to string" + ", url string, payload binary" * with_payload
    run = F.floor(F.col("frame") / RUN).alias("run")
    work = index.groupBy("bundle", run).agg(F.collect_list(F.struct("frame", "offset")).alias("places"))
    count = index.select("bundle", run).distinct().count()
    return work.select("bundle", "places").repartition(max(1, -(-count // RUNS))).mapInArrow(read, schema)


def read_record(folder: str, bundle: str, frame: int, offset: int) -> dict:
    """One record by its place in the index: decompresses one frame."""
    files, root = opened(folder)
    reader = BundleReader(files, f"{root}/{bundle}")
    try:
        return parsed(reader.frame(frame), offset)[0]
    finally:
        reader.close()


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes bundles to the shared folder and reads all of them back."""
    spark: SparkSession = pages.sparkSession
    folder = shared_dir(spark, "warc")
    index = written(write_bundles(pages, folder, id_col, url_col, payload_col, least_bytes), "warc-index")
    kind = pages.schema[id_col].dataType
    back = read_bundles(index, folder)
    return back.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
