"""WARC archives of pages: one Zstandard frame a record, with a dictionary in front.

A file (`.warc.zst`) begins with a skippable frame that holds a Zstandard dictionary (itself
compressed), trained on the file's first records, about SAMPLE_BYTES of them. Every record is
compressed alone with that dictionary, so any record can be read with the first frame and its
own. A file whose records cannot train a dictionary (a few, or all empty) has no first frame.

Records of equal payloads of at least `least` bytes are stored once: the row with the largest
page_id (ties: the largest url) is the response, the others are revisits of it, which hold the
HTTP header only and so the payload's length. Smaller payloads are all responses. Payloads are
equal when length and SHA-1 are.

A null html is an empty payload. Null page_ids count as smallest; a revisit of a response
without page_id refers to null. Rows that repeat the response in page_id, url and payload are
the same record, written as often as they come. A null url is left out of the record; its
control characters are percent-encoded, as a header line cannot hold them. An empty table
gives no file and no record. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.llm.common import Scratch

LEAST = 1000  # bytes of a payload that is stored once
FILE_BYTES = 16 << 20  # compressed bytes of a file
SAMPLE_BYTES = 4 << 20  # of the records that train a file's dictionary
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # pages have no date of their own
# fixed values of the formats
_DICTIONARY_MAGIC = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FRAME_MAGIC = 0xFD2FB528
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 16
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def _record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{url}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: tuple | None, date: str = DATE) -> bytes:
    """One record; refers: (page_id, url) of the response that a revisit refers to."""
    url = url if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", _record_id(page_id, url, f"{digest}/revisit" if refers else digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Page-ID", page_id),
    ]
    if refers:
        first = refers[1] if refers[1] is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", refers[1])
        fields += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_id(refers[0], first, digest)),
            ("WARC-Refers-To-Target-URI", first),
            ("WARC-Refers-To-Date", date),
            ("Refers-To-Page-ID", refers[0]),
        ]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"".join([_VERSION, b"\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"])


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version.encode() != _VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']}: the block is not as long as its header says")
    return fields, rest[:size]


def trained(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the records; None where Zstandard finds too little in them."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=512, d=8, f=20, accel=1, level=LEVEL)
    except zstandard.ZstdError:
        return None


class WarcFile:
    """A file in memory: its records are compressed when the dictionary's sample is there."""

    def __init__(self, sample_bytes: int) -> None:
        self.sample_bytes = sample_bytes
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.records = self.raw = self.size = 0
        self.parts: list[bytes] = []
        self.pack = None

    def add(self, raw: bytes) -> None:
        self.records += 1
        self.raw += len(raw)
        if self.pack:
            self._put(self.pack(raw))
            return
        self.waiting.append(raw)
        self.waiting_bytes += len(raw)
        if self.waiting_bytes >= self.sample_bytes:
            self._start()

    def _put(self, part: bytes) -> None:
        self.parts.append(part)
        self.size += len(part)

    def _start(self) -> None:
        known = trained(self.waiting)
        if known:
            known.precompute_compress(level=LEVEL)
            frame = zstandard.ZstdCompressor(level=19).compress(known.as_bytes())
            self._put(struct.pack("<II", _DICTIONARY_MAGIC, len(frame)) + frame)
            self.pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True).compress
        else:
            self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        for raw in self.waiting:
            self._put(self.pack(raw))
        self.waiting = []

    def content(self) -> bytes:
        if not self.pack:
            self._start()
        return b"".join(self.parts)


def frames(content: bytes | memoryview) -> Iterator[tuple[int, bytes]]:
    """Offset and record of every frame of a file."""
    content, at, known = memoryview(content), 0, None
    unpack = zstandard.ZstdDecompressor()
    while at < len(content):
        (magic,) = struct.unpack_from("<I", content, at)
        if magic in _SKIPPABLE:
            (size,) = struct.unpack_from("<I", content, at + 4)
            if magic == _DICTIONARY_MAGIC and at == 0:
                body = bytes(content[8 : 8 + size])
                if struct.unpack_from("<I", body)[0] == _FRAME_MAGIC:
                    body = unpack.decompress(body)
                known = zstandard.ZstdCompressionDict(body)
                unpack = zstandard.ZstdDecompressor(dict_data=known)
            at += 8 + size
            continue
        begin, frame, out = at, unpack.decompressobj(), []
        while not frame.eof:
            chunk = content[at : at + _CHUNK]
            if not len(chunk):
                raise ValueError("the file ends inside a record")
            out.append(frame.decompress(chunk))
            at += len(chunk)
        at -= len(frame.unused_data)
        yield begin, b"".join(out)


def _store(uri: str, raw: bytes) -> None:
    """Write under another name first, so a reader never sees half a file."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_output_stream(path + ".part") as out:
        out.write(raw)
    system.move(path + ".part", path)


_MANIFEST = pa.schema([("name", pa.string()), ("records", pa.int64()), ("raw_bytes", pa.int64()), ("bytes", pa.int64())])


def write_warcs(
    pages: DataFrame, folder: str, scratch: Scratch | None = None, least: int = LEAST, file_bytes: int = FILE_BYTES,
    sample_bytes: int = SAMPLE_BYTES, date: str = DATE,
) -> DataFrame:
    """Write (page_id, url, html) rows as files of about file_bytes; the returned rows name the
    files that count (what a lost attempt left is in no row) and must be written or counted once."""
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")
    ).withColumn("digest", F.sha1("html")).withColumn("n", F.octet_length("html").cast("long"))
    # written first, so that Spark knows its size when it plans the join
    stored = scratch.table(
        rows.where(F.col("n") >= least).groupBy("digest", "n")
        .agg(F.max(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1").drop("copies"),
        "stored",
    )
    planned = rows.join(stored, ["digest", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.struct("page_id", "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        seq, file = 0, WarcFile(sample_bytes)

        def close() -> pa.RecordBatch:
            nonlocal seq, file
            name = f"{context.partitionId():06d}-{seq:06d}-{context.taskAttemptId()}.warc.zst"
            content = file.content()
            _store(f"{folder}/{name}", content)
            row = {"name": [name], "records": [file.records], "raw_bytes": [file.raw], "bytes": [len(content)]}
            seq, file = seq + 1, WarcFile(sample_bytes)
            return pa.RecordBatch.from_pydict(row, schema=_MANIFEST)

        for batch in batches:
            for page_id, url, html, digest, again, first_id, first_url in zip(*batch.columns):
                refers = (first_id.as_py(), first_url.as_py()) if again.as_py() else None
                file.add(record(page_id.as_py(), url.as_py(), html.as_py(), digest.as_py(), refers, date))
                if file.size >= file_bytes:
                    yield close()
        if file.records:
            yield close()

    return planned.select(
        "page_id", "url", "html", "digest", revisit.alias("again"), "first.page_id", "first.url"
    ).toDF("page_id", "url", "html", "digest", "again", "first_id", "first_url").mapInArrow(
        write, "name string, records long, raw_bytes long, bytes long"
    )


_READ = [
    ("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_warcs(spark: SparkSession, folder: str, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the files that the manifest names; with `payloads` their bytes too
    (null for revisits). A response whose payload does not have its digest is an error."""
    schema = pa.schema(_READ + [("payload", pa.binary())] * payloads)

    def rows_of(content: pa.Buffer) -> Iterator[tuple]:
        for _, raw in frames(content):
            fields, block = parsed(raw)
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(http.rsplit(b"Content-Length: ", 1)[1])
            digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
            if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not have its digest")
            row = (
                _number(fields.get("Page-ID")), fields.get("WARC-Target-URI"), fields["WARC-Record-ID"], size, digest, kind,
                _number(fields.get("Refers-To-Page-ID")),
            )
            yield (*row, payload if kind == "response" else None) if payloads else row

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)

        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for row in rows_of(content.as_buffer()):
                    held.append(row)
                    size += 200 + (len(row[-1] or b"") if payloads else 0)
                    if size > 1 << 22:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    kinds = "page_id long, url string, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.join(manifest.select("name"), "name", "left_semi").select("content").mapInArrow(
        read, kinds + ", payload binary" * payloads
    )
