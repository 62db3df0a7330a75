"""WARC archives as bundles of independent Zstandard frames with a seek table, and an index into them."""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lapwise.llm.common import ship, stage_large

#: Raw bytes after which a frame, and after which a bundle, is closed.
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 8 << 20
# Fixed values of the seekable format: kind of the skippable frame that holds the table, and the table's last bytes.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_FRAME, _FOOTER, _HEAD = struct.Struct("<II"), struct.Struct("<IBI"), struct.Struct("<II")
# Fixed value of the standard for records whose payload another record holds.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_RECORD = "record_id string, page_id string, record_type string, url string, payload_digest string, payload_bytes long, refers_to string"


def record_id(page: str | None, digest: str) -> str:
    """The same for the same page id and payload, so that a retried task writes the same archive."""
    name = hashlib.sha256(f"{'' if page is None else page}\n{digest}".encode()).digest()
    return f"urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}"


def one_line(text: str) -> str:
    """A header value without blanks and control characters, which would end it."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", text)


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> tuple[str, bytes]:
    """Identifier and bytes of a response, or of a revisit if `refers_to` names a page."""
    name = record_id(page, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    if page is not None:
        lines.append(f"X-Page-ID: {quote(page)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"X-Refers-To-Page-ID: {quote(refers_to)}"]
    return name, "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Frames of whole records, and at the end the table of their sizes."""

    def __init__(self, level: int, frame_bytes: int) -> None:
        self._compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self._frame_bytes = frame_bytes
        self._frames: list[bytes] = []
        self._sizes: list[tuple[int, int]] = []
        self._open: list[bytes] = []
        self._filled = 0
        self.entries: list[tuple] = []
        self.raw = 0

    def add(self, key: tuple, data: bytes) -> None:
        """Append a record; `key` goes into the index with the record's frame, offset in it and length."""
        self.entries.append((*key, len(self._frames), self._filled, len(data)))
        self._open.append(data)
        self._filled += len(data)
        self.raw += len(data)
        if self._filled >= self._frame_bytes:
            self._close()

    def _close(self) -> None:
        if self._open:
            self._frames.append(self._compress(b"".join(self._open)))
            self._sizes.append((len(self._frames[-1]), self._filled))
            self._open, self._filled = [], 0

    def content(self) -> bytes:
        self._close()
        table = b"".join(_FRAME.pack(*sizes) for sizes in self._sizes) + _FOOTER.pack(len(self._sizes), 0, _SEEKABLE)
        return b"".join(self._frames) + _HEAD.pack(_SKIPPABLE, len(table)) + table


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """Start, compressed size and raw size of each frame, read from the end of a bundle."""
    count, _, magic = _FOOTER.unpack(content[-_FOOTER.size :])
    if magic != _SEEKABLE:
        raise ValueError("a bundle without a seek table")
    begin = len(content) - _FOOTER.size - count * _FRAME.size
    out, start = [], 0
    for small, large in _FRAME.iter_unpack(content[begin : len(content) - _FOOTER.size]):
        out.append((start, small, large))
        start += small
    if start != begin - _HEAD.size:
        raise ValueError("a seek table that does not fit its bundle")
    return out


def frame(content: bytes, place: tuple[int, int, int]) -> bytes:
    start, small, large = place
    return zstandard.ZstdDecompressor().decompress(content[start : start + small], max_output_size=large)


def parse(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at `offset`, and where the next one begins."""
    end = data.index(b"\r\n\r\n", offset)
    first, *lines = data[offset:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at byte {offset}")
    headers = dict(line.split(": ", 1) for line in lines)
    begin = end + 4
    stop = begin + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {offset} has no end")
    return headers, data[begin:stop], stop + 4


def facts(headers: dict[str, str], block: bytes) -> tuple:
    """Fields of a record and its payload; a payload that does not have its digest is an error."""
    head = block.index(b"\r\n\r\n") + 4
    size = int(dict(line.split(": ", 1) for line in block[: head - 4].decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = block[head:] if headers["WARC-Type"] == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    page, other = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    return (headers["WARC-Record-ID"][1:-1], page and unquote(page), headers["WARC-Type"], headers.get("WARC-Target-URI"),
            digest, size, other and unquote(other), payload)


def with_revisits(pages: DataFrame, least_bytes: int = 100, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Add `payload`, `payload_digest` and `refers_to`: the least id with an equal payload, for all others with it.

    Ids of payloads that come once are dropped before the join, which adaptive
    execution splits where one payload has many rows.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    named = pages.withColumns({"payload": payload, "payload_digest": F.sha2(payload, 256)})
    large = F.octet_length("payload") >= least_bytes
    firsts = (
        named.where(large).groupBy("payload_digest")
        .agg(F.min(id_col).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    )
    other = large & ~F.col(id_col).eqNullSafe(F.col("first"))
    return named.join(firsts, "payload_digest", "left").withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def write_archives(
    pages: DataFrame,
    least_bytes: int = 100,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    level: int = 3,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write one WARC record for each row into seekable bundles; returns the stored table of bundles.

    A bundle is a file's bytes (`content`): Zstandard frames of whole records, each
    of which can be read alone, and a skippable frame with the sizes of all frames
    as the footer. `entries` maps `record_id` to frame, offset in the raw frame and
    length. The table goes to the shared folder, so lost executors re-read it;
    `export` turns it into `.warc.zst` files, which any WARC reader takes.

    Of equal payloads of at least `least_bytes` bytes the row of the least id is a
    response, and the others are revisits of it without the payload; smaller ones
    are all responses. A missing payload is an empty one, a missing url has no
    header. Rows without an id come after all others: they revisit, and among
    themselves are all responses. Repeated rows with the least id are all
    responses under one record id. A row longer than a bundle is one frame of its
    own. Control characters and blanks of urls are percent-encoded. Other columns
    are not kept, whatever their names. An empty table gives no bundle.
    """
    spark = pages.sparkSession
    ship(spark)
    entry_type = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        bundle = Bundle(level, frame_bytes)

        def closed() -> pa.RecordBatch:
            keys = ("record_id", "frame", "offset", "length")
            return pa.RecordBatch.from_arrays([
                pa.array([f"{task:06d}-{number:06d}"]), pa.array([len(bundle.entries)], pa.int64()), pa.array([bundle.raw], pa.int64()),
                pa.array([bundle.content()], pa.binary()), pa.array([[dict(zip(keys, e)) for e in bundle.entries]], entry_type),
            ], names=["bundle", "records", "raw_bytes", "content", "entries"])

        for batch in batches:
            for page, url, payload, digest, other in zip(*(batch.column(c) for c in ("page", "url", "payload", "digest", "other"))):
                name, data = record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), other.as_py(), date)
                if bundle.raw and bundle.raw + len(data) > bundle_bytes:
                    yield closed()
                    bundle, number = Bundle(level, frame_bytes), number + 1
                bundle.add((name,), data)
        if bundle.entries:
            yield closed()

    read = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).alias("html")
    )
    rows = with_revisits(read, least_bytes).select(
        F.col("page_id").cast("string").alias("page"), "url", "payload", F.col("payload_digest").alias("digest"),
        F.col("refers_to").cast("string").alias("other"),
    )
    schema = ("bundle string, records long, raw_bytes long, content binary, "
              "entries array<struct<record_id: string, frame: int, offset: long, length: long>>")
    # the frames are compressed already
    return stage_large(rows.mapInArrow(bundles, schema), "warc", 4 * bundle_bytes, compression="none")


def index(bundles: DataFrame) -> DataFrame:
    """One row for each record: `record_id`, `bundle`, `frame`, `offset` in the raw frame, `length`."""
    return bundles.select("bundle", F.explode("entries").alias("e")).select("e.record_id", "bundle", "e.frame", "e.offset", "e.length")


def _rows_of(found: Iterable[tuple], payloads: bool) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 8
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["record_id", "page_id", "record_type", "url", "payload_digest", "payload_bytes", "refers_to", "payload"]
    keep = 8 if payloads else 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:keep], types)], names=names[:keep])


def _typed(df: DataFrame, id_type: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def read_archives(bundles: DataFrame, id_type: str = "long", payloads: bool = False, content: str | Column = "content") -> DataFrame:
    """Read every record of bundles, frame after frame, and check each payload against its digest.

    `bundles` is a stored table or `spark.read.format("binaryFile")` over exported
    files. Returns `record_id`, `page_id`, `record_type`, `url`, `payload_digest`,
    `payload_bytes` (of the full payload, also for revisits), `refers_to` (the
    response's page id for revisits) and, if asked for, `payload` (null for
    revisits). A bundle or payload that is damaged is an error.
    """
    ship(bundles.sparkSession)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("content"):
                data = cell.as_py()
                for place in seek_table(data):
                    raw, offset, found = frame(data, place), 0, []
                    while offset < len(raw):
                        headers, block, offset = parse(raw, offset)
                        found.append(facts(headers, block))
                    yield _rows_of(found, payloads)

    schema = _RECORD + (", payload binary" if payloads else "")
    chosen = F.col(content) if isinstance(content, str) else content
    return _typed(bundles.select(chosen.alias("content")).mapInArrow(records, schema), id_type)


def fetch(bundles: DataFrame, wanted: DataFrame, id_type: str = "long") -> DataFrame:
    """The records whose `record_id` is in `wanted`, with their payloads: only their frames are decompressed.

    The index tells bundle, frame and offset of each. Places go to their bundle as
    one row, bounded by its number of records. Unknown ids give no row, repeated
    ones one; record ids that several rows share give all of these.
    """
    ship(bundles.sparkSession)
    places = index(bundles).join(wanted.select("record_id").distinct(), "record_id").groupBy("bundle").agg(
        F.collect_list(F.struct("frame", "offset")).alias("places")
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, places in zip(batch.column("content"), batch.column("places")):
                data = cell.as_py()
                table, opened, raw, found = seek_table(data), None, b"", []
                for place in sorted((p["frame"], p["offset"]) for p in places.as_py()):
                    if place[0] != opened:
                        opened, raw = place[0], frame(data, table[place[0]])
                    headers, block, _ = parse(raw, place[1])
                    found.append(facts(headers, block))
                yield _rows_of(found, True)

    rows = bundles.select("bundle", "content").join(places, "bundle").select("content", "places")
    return _typed(rows.mapInArrow(records, _RECORD + ", payload binary"), id_type)


def export(bundles: DataFrame, folder: str) -> DataFrame:
    """Write each bundle as `<folder>/<bundle>.warc.zst` and return the paths.

    `folder` is one that all executors see under the same path, such as a mounted
    store. A file gets its name when it is whole, so a retried task leaves no part.
    """
    ship(bundles.sparkSession)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            paths = []
            for name, cell in zip(batch.column("bundle").to_pylist(), batch.column("content")):
                paths.append(os.path.join(folder, f"{name}.warc.zst"))
                part = f"{paths[-1]}.{uuid.uuid4().hex}"
                with open(part, "wb") as out:
                    out.write(cell.as_py())
                os.replace(part, paths[-1])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return bundles.select("bundle", "content").mapInArrow(files, "path string")
