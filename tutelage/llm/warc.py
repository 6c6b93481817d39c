"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; after the last frame stands a seek table in a skippable
frame, as the Zstandard seekable format lays down, so that any reader finds every frame from the end of a file. The index
maps a record's identifier to archive, frame and place in the decompressed frame; one record costs one range read.

Tasks write files of their own through the store that the folder's address names, under names that no other attempt
has; only archives named in the index exist for a reader, so a task that is run again does no harm.

Of records with equal payloads of ``revisit_bytes`` at least, that of the least page id is the response and the others are
revisits without payload. Only digests are grouped, and only those that occur more than once are joined back.

Defined cases: a null payload is an empty one; a null url or id is left out of the record; null ids revisit the least id of
equal payloads and are responses if there is none; repeated rows of the response's id are responses; line breaks in a
url are escaped; an empty table writes no archive; columns other than those named are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import materialise, utf8

#: Decompressed bytes after which a frame ends, and compressed bytes after which an archive ends.
FRAME_BYTES, ARCHIVE_BYTES = 1 << 18, 1 << 26
# Fixed values of the Zstandard seekable format and of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

INDEX = "record_id string, page_id bigint, archive string, frame int, frame_start bigint, frame_bytes bigint, record_start bigint, record_bytes bigint"
RECORD = "record_id string, page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"


def store_of(address: str) -> tuple[pafs.FileSystem, str]:
    """The store of an address and the path in it. Hadoop's names of the S3 scheme are read as the one name it has here."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", address))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, mark: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{mark}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[str, bytes]:
    """Identifier and bytes of a response, or of a revisit of the page ``refers_to``."""
    mark = digest(payload)
    name = record_id(page_id, mark)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, mark)), ("Refers-To-Page-ID", str(refers_to))]
    block = http + (payload if refers_to is None else b"")
    head += [("WARC-Payload-Digest", f"sha1:{mark}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return name, b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:] if line)


def parse(data: bytes, at: int = 0) -> Iterator[tuple[tuple, int]]:
    """The records of a decompressed frame from ``at``, each in the order of ``RECORD``, with the place after it."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        head = _fields(data[at:end])
        block = data[end:end + int(head["Content-Length"])]
        cut = block.index(b"\r\n\r\n") + 4
        http, payload = _fields(block[:cut]), block[cut:]
        kind, mark = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (digest(payload) != mark or len(payload) != int(http["Content-Length"])):
            raise ValueError(f"{head['WARC-Record-ID']}: the payload does not have its digest")
        number = {k: int(head[k]) if k in head else None for k in ("Page-ID", "Refers-To-Page-ID")}
        at = end + len(block) + 4
        yield (head["WARC-Record-ID"], number["Page-ID"], head.get("WARC-Target-URI"), kind, mark, int(http["Content-Length"]), number["Refers-To-Page-ID"],
               payload if kind == "response" else None), at


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that lists compressed and decompressed sizes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(source, size: int) -> list[tuple[int, int, int]]:
    """``(start, compressed, decompressed)`` of each frame of an open archive."""
    source.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the archive")
    entry = 12 if flags & 0x80 else 8
    source.seek(size - 9 - count * entry)
    table, out, start = source.read(count * entry), [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        out.append((start, packed, plain))
        start += packed
    return out


class Bundle:
    """One archive being written; index rows are complete when it is closed."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, where = store_of(self.path)
        store.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.out, self.zstd = store.open_output_stream(where, compression=None), zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.rows: list[list] = []
        self.waiting: list[tuple[str, int | None, bytes]] = []
        self.plain = self.start = 0

    def add(self, name: str, page_id: int | None, data: bytes) -> None:
        self.waiting.append((name, page_id, data))
        self.plain += len(data)
        if self.plain >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            packed, at = self.zstd.compress(b"".join(d for _, _, d in self.waiting)), 0
            for name, page_id, data in self.waiting:
                self.rows.append([name, page_id, self.path, len(self.frames), self.start, len(packed), at, len(data)])
                at += len(data)
            self.out.write(packed)
            self.frames.append((len(packed), self.plain))
            self.start += len(packed)
            self.waiting, self.plain = [], 0

    def close(self) -> list[list]:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return self.rows


def _batch(rows: list, schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k.type) for i, k in enumerate(kinds)], names=kinds.names)


def write(pages: DataFrame, folder: str, revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in ``folder``; returns their index, itself written to the shared folder."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), utf8("html").alias("payload"))
    marked = rows.withColumn("mark", F.sha1("payload"))
    alike = marked.filter(F.length("payload") >= revisit_bytes).groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1")
    alike = materialise(alike.select("mark", "first"), "alike")  # its size is then known: a small one is broadcast, and no page is moved
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    typed = marked.join(alike, "mark", "left").select("page_id", "url", "payload", refers.alias("refers_to"))
    schema = T._parse_datatype_string(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")], strict=True):
                bundle = bundle or Bundle(folder)
                name, data = record(page_id, url, payload, refers_to)
                bundle.add(name, page_id, data)
                if bundle.start >= ARCHIVE_BYTES:
                    yield _batch(bundle.close(), schema)
                    bundle = None
        if bundle:
            yield _batch(bundle.close(), schema)

    return materialise(typed.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """All records of the archives that ``index`` names, by their seek tables, in the columns of ``RECORD``."""
    archives = index.select("archive").distinct()
    archives = archives.repartition(max(1, archives.count()), "archive")
    schema = T._parse_datatype_string(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, where = store_of(path)
                with store.open_input_file(where) as source:
                    for start, packed, plain in read_seek_table(source, source.size()):
                        source.seek(start)
                        data = zstd.decompress(source.read(packed), max_output_size=plain)
                        yield _batch([r for r, _ in parse(data)], schema)

    return archives.mapInArrow(run, RECORD)


def fetch(index: DataFrame) -> DataFrame:
    """The records of the index rows given, each by one range read of its frame."""
    schema = T._parse_datatype_string(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                store, where = store_of(row["archive"])
                with store.open_input_file(where) as source:
                    source.seek(row["frame_start"])
                    data = zstd.decompress(source.read(row["frame_bytes"]))
                one = data[row["record_start"]:row["record_start"] + row["record_bytes"]]
                yield _batch([r for r, _ in parse(one)], schema)

    return index.mapInArrow(run, RECORD)
