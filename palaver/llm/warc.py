"""WARC archives: writing, normalising whole-file gzip, random access.

:func:`write` stores a record per page in archives that are one gzip stream each, a
task's records in files of about ``ARCHIVE_BYTES``.  :func:`normalise` inflates each
such stream once, front to back, writes every record as a gzip member of its own
and beside the archive an index of offsets (a JSON line for each record).
:func:`read` fetches records by offset and length.

Files lie in the shared folder.  A task gives its files names of their own and
reports them in a table; files of a task that was lost are in no table and never
read.  Memory: one record and a chunk of the stream.

Of records with equal payloads of at least ``min_bytes``, that of the largest page id
is the response and the others revisit it; a NULL id is the smallest, and of rows
with equal ids the last of the table is taken.  A NULL html is an empty payload.  A NULL
url is an empty one; blanks and control characters in urls are percent-encoded.
``pages`` must be a scan of files, so that rows keep their places if read again.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import shared_folder, spread, utf8, written

ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31


def base32_sha1(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(page_id: int | None, url: str, payload: bytes, digest: str, n_bytes: int,
           refers_to: tuple[int | None] | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit, which has no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {n_bytes}\r\n\r\n").encode()
    block = http if refers_to else http + payload
    lines = [f"WARC-Type: {'revisit' if refers_to else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>",
             f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}",
             f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Page-ID: {'' if page_id is None else page_id}"]
    if refers_to:
        first = "" if refers_to[0] is None else refers_to[0]
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Page-ID: {first}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               min_bytes: int = 0) -> DataFrame:
    """Payload, digest and the page that each page revisits (a struct, NULL for responses)."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.coalesce(url, F.lit("")).alias("url"),
        utf8(html).alias("payload"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload")})
    first = rows.groupBy("digest").agg(F.max(F.struct("page_id", "place")).alias("first"))
    again = (F.col("place") != F.col("first.place")) & (F.col("n_bytes") >= min_bytes)
    return rows.join(first, "digest").select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "digest",
        F.col("n_bytes").cast("long").alias("n_bytes"),
        F.when(again, F.struct(F.col("first.page_id").alias("page_id"))).alias("refers_to"))


class _Output:
    """An archive file that grows, with a name of its own."""

    def __init__(self, folder: str):
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        self.path, self.store, self.local = f"{folder}/{name}", store, f"{path}/{name}"
        self.stream = store.open_output_stream(self.local, compression=None)
        self.size = 0

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)


def write(roles: DataFrame, folder: str) -> DataFrame:
    """Archives of one gzip stream each; ``path, records, bytes`` of every archive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None

        def close():
            out.put(packer.flush())
            out.stream.close()
            return pa.RecordBatch.from_pylist(
                [{"path": out.path, "records": records, "bytes": out.size}])

        for batch in batches:
            for row in range(batch.num_rows):
                page, url, payload, digest, n, refers = (c[row].as_py() for c in batch.columns)
                if out is None:
                    out, packer, records = _Output(folder), zlib.compressobj(wbits=_GZIP), 0
                out.put(packer.compress(record(page, url, payload or b"", base32_sha1(digest), n,
                                               refers and (refers["page_id"],))))
                records += 1
                if out.size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return written(roles.mapInArrow(run, "path string, records long, bytes long"), "archives")


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or more."""
    unpacker = zlib.decompressobj(_GZIP)
    while data := stream.read(CHUNK):
        while data:
            yield unpacker.decompress(data)
            data = b""
            if unpacker.eof:
                data, unpacker = unpacker.unused_data, zlib.decompressobj(_GZIP)


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def records_of(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head fields and whole bytes of each record of an inflated stream."""
    held = bytearray()
    end = None
    for part in parts:
        held += part
        while True:
            if end is None:
                at = held.find(b"\r\n\r\n")
                if at < 0:
                    break
                fields = parse_head(bytes(held[:at]))
                end = at + 4 + int(fields["Content-Length"]) + 4
            if len(held) < end:
                break
            yield fields, bytes(held[:end])
            del held[:end]
            end = None
    if held:
        raise ValueError("the archive ends within a record")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """A gzip member for each record; ``path, place, length, page_id`` of every record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, local = fs.FileSystem.from_uri(path)
                out, found = _Output(folder), []
                with store.open_input_stream(local, compression=None) as stream, \
                        out.store.open_output_stream(f"{out.local}.idx",
                                                     compression=None) as index:
                    for fields, whole in records_of(inflated(stream)):
                        packer, place = zlib.compressobj(wbits=_GZIP), out.size
                        out.put(packer.compress(whole) + packer.flush())
                        entry = {"path": out.path, "place": place, "length": out.size - place,
                                 "page_id": int(fields["WARC-Page-ID"])
                                 if fields["WARC-Page-ID"] else None}
                        index.write((json.dumps(entry) + "\n").encode())
                        found.append(entry)
                        if len(found) == 5000:
                            yield pa.RecordBatch.from_pylist(found, INDEX)
                            found = []
                out.stream.close()
                yield pa.RecordBatch.from_pylist(found, INDEX)

    return written(spread(archives.select("path"), "path").mapInArrow(
        run, "path string, place long, length long, page_id long"), "warc-index")


INDEX = pa.schema([("path", pa.string()), ("place", pa.int64()), ("length", pa.int64()),
                   ("page_id", pa.int64())])
RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                    ("refers_to", pa.int64()), ("payload", pa.binary())])


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``index`` (any part of it) points to, one row each.

    Digests of responses are taken from the payload and must agree with the record's.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            found, held = [], 0
            for path, place, length in zip(*(c.to_pylist() for c in batch)):
                if path != name:
                    store, local = fs.FileSystem.from_uri(path)
                    name, source = path, store.open_input_file(local)
                source.seek(place)
                (fields, whole), = records_of([zlib.decompress(source.read(length), _GZIP)])
                row, size = _row(fields, whole)
                if not payloads:
                    row["payload"] = None
                found.append(row)
                held += size if payloads else 200
                if held > CHUNK:
                    yield pa.RecordBatch.from_pylist(found, RECORD)
                    found, held = [], 0
            yield pa.RecordBatch.from_pylist(found, RECORD)

    rows = index.select("path", "place", "length").sortWithinPartitions("path", "place")
    return rows.mapInArrow(run, "page_id long, url string, record_type string, payload_digest "
                           "string, payload_bytes long, refers_to long, payload binary")


def _row(fields: dict[str, str], whole: bytes) -> tuple[dict, int]:
    head = whole.index(b"\r\n\r\n") + 4
    http = whole.index(b"\r\n\r\n", head) + 4
    kind, payload = fields["WARC-Type"], whole[http:-4]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    n_bytes = int(whole[head:http].split(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
    if kind == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
        n_bytes = len(payload)
    number = {k: int(v) if (v := fields.get(k)) else None
              for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID")}
    return {"page_id": number["WARC-Page-ID"], "url": fields["WARC-Target-URI"],
            "record_type": kind, "payload_digest": digest, "payload_bytes": n_bytes,
            "refers_to": number["WARC-Refers-To-Page-ID"],
            "payload": payload if kind == "response" else None}, len(whole)


def archived(pages: DataFrame, **columns) -> DataFrame:
    """Write, normalise and index ``pages``; the index."""
    folder = shared_folder(pages.sparkSession, "warc")
    return normalise(write(with_roles(pages, **columns), f"{folder}/streams"), f"{folder}/records")
