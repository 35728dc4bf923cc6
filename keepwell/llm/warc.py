"""WARC archives: one gzip member per record, written and read in sequence.

The writer stores a payload once: of equal payloads the record with the smallest id is
a ``response``, the others are ``revisit`` records that name it and carry the HTTP
headers (with the payload's length) and the payload's digest. Which payloads repeat is
an aggregate over digests; only repeated digests are joined back.

The reader inflates each member in steps, frames the block by Content-Length and hashes
block and payload as they pass, so its memory does not depend on record or archive size
unless payloads are asked for.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import Members, scratch, ship, text_of, written
from keepwell.llm.store import new_file, reader

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_FORM = "<urn:keepwell:page:{}>"
#: A new archive is begun after this many bytes.
ARCHIVE_BYTES = 256 << 20
_STEP = 1 << 20
#: A header that has not ended after this many bytes is none.
HEAD_BYTES = 1 << 20
_NO_ID = "none"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION, f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers],
             f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return deflate.compress(head) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


def _page(page_id, url, payload: bytes, refers_to, date: str, level: int) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    name = lambda x: ID_FORM.format(_NO_ID if x is None else x)
    headers = [("WARC-Record-ID", name(page_id)), ("WARC-Date", date)]
    if url:
        # control characters, blanks and non-ASCII cannot stand in a header
        headers.append(("WARC-Target-URI", urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    headers += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if refers_to is None:
        return record("response", headers, http + payload, level)
    headers += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    return record("revisit", headers, http, level)


def _write(batches: Iterable[pa.RecordBatch], folder: str, date: str, level: int, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, url, payload, refers_to) to archives; a row per finished archive."""
    out, uri, size, records = None, "", 0, 0

    def done() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_pydict({"path": [uri], "records": [records], "bytes": [size]})

    for batch in batches:
        for page_id, url, payload, refers in zip(*[c.to_pylist() if i != 2 else c for i, c in enumerate(batch.columns)],
                                                 strict=True):
            if out is None:
                uri, out = new_file(folder, ".warc.gz")
                info = record("warcinfo", [("WARC-Record-ID", "<urn:keepwell:archive>"), ("WARC-Date", date),
                                           ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", level)
                out.write(info)
                size, records = len(info), 0
            data = _page(page_id, url, payload.as_buffer().to_pybytes(), refers, date, level)
            out.write(data)
            size, records = size + len(data), records + 1
            if size >= archive_bytes:
                yield done()
                out = None
    if out is not None:
        yield done()


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", revisit_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", level: int = 6,
          archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row to archives in ``folder`` (a new one under the shared folder if
    none is given) and return their manifest (path, records, bytes).

    Payloads are the text in UTF-8, null as empty. Of equal payloads of at least
    ``revisit_bytes`` bytes the row with the smallest id is the response, rows with other
    ids revisit it; rows that repeat that id and payload are responses too. Rows with a null
    id revisit the response like others; where no row has an id, all are responses. A null
    or empty url is left out of the record. An empty table writes no archive.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or scratch(spark, "warc")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(text_of(payload_col), "utf-8").alias("payload"))
    key: list[Column] = [F.octet_length("payload").alias("size"), F.sha1("payload").alias("sha")]
    first = written(rows.select("id", *key).where(F.col("size") >= revisit_bytes).groupBy("size", "sha")
                    .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeats")
    # only rows whose digest may recur meet the join; the repeats are a written table, so small ones
    # are broadcast, else the planner splits hot digests
    met, alone = Members(first, "size", "sha").split(rows.select("*", *key), "size", "sha")
    link = F.when(~F.coalesce(F.col("id") == F.col("first"), F.lit(False)), F.col("first")).alias("refers")
    linked = (alone.select("id", "url", "payload", F.lit(None).cast(first.schema["first"].dataType).alias("refers"))
              .unionByName(met.join(first, ["size", "sha"], "left").select("id", "url", "payload", link)))
    return written(linked.mapInArrow(partial(_write, folder=folder, date=date, level=level, archive_bytes=archive_bytes),
                                     "path string, records long, bytes long"), "manifest")


@dataclass
class Record:
    """What the reader tells of a record. ``payload`` only if asked for; of a revisit it is
    the empty rest of its block."""

    offset: int
    headers: dict[str, str]
    block_bytes: int = 0
    payload_bytes: int = 0
    http: dict[str, str] = field(default_factory=dict)
    block_digest: str = ""
    payload_digest: str = ""
    payload: bytes | None = None


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name. Bytes that are not UTF-8 are read as U+FFFD each."""
    text = lambda x: x.strip().decode("utf-8", "replace")
    return {text(k).lower(): text(v) for k, _, v in (x.partition(b":") for x in lines if x)}


class Archive:
    """Reads the records of a stream of gzip members in sequence."""

    def __init__(self, stream, keep_payload: bool = False, step: int = _STEP):
        self._stream, self._keep, self._step = stream, keep_payload, step
        self._raw, self._at = b"", 0  # compressed bytes not yet inflated; offset of their first

    def _inflated(self) -> Iterator[bytes]:
        """The current member, a step at a time."""
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            self._raw = self._raw or self._stream.read(self._step)
            before = len(self._raw)
            data = inflate.decompress(self._raw, self._step)
            if not (before or data):
                raise ValueError(f"archive ends inside a member near byte {self._at}")
            self._raw = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            self._at += before - len(self._raw)
            if data:
                yield data

    def __iter__(self) -> Iterator[Record]:
        while True:
            if not self._raw:
                self._raw = self._stream.read(self._step)
                if not self._raw:
                    return
            yield self._record()

    def _record(self) -> Record:
        start, chunks, have = self._at, self._inflated(), b""

        def until(mark: bytes) -> bytes:
            nonlocal have
            while mark not in have:
                data = next(chunks, None)
                if data is None or len(have) > HEAD_BYTES:
                    raise ValueError(f"no end of header in the record at byte {start}")
                have += data
            head, _, have = have.partition(mark)
            return head

        lines = until(b"\r\n\r\n").split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {start}")
        out = Record(start, _fields(lines[1:]))
        length = out.headers.get("content-length", "")
        if not re.fullmatch(r"\d+", length):
            raise ValueError(f"no Content-Length in the record at byte {start}")
        out.block_bytes = left = int(length)
        block, payload, kept = hashlib.sha1(), hashlib.sha1(), []
        in_head, head = out.headers.get("content-type", "").startswith("application/http"), b""
        while left:
            have = have or next(chunks, b"")
            if not have:
                raise ValueError(f"the record at byte {start} is shorter than its Content-Length")
            part, have = have[:left], have[left:]
            left -= len(part)
            block.update(part)
            if in_head:
                # a message whose head does not end, or not within its bound, is payload throughout
                seen, head = max(0, len(head) - 3), head + part
                ends = head.find(b"\r\n\r\n", seen)
                if ends < 0 and left and len(head) <= HEAD_BYTES:
                    continue
                in_head, part = False, head
                if 0 <= ends <= HEAD_BYTES:
                    out.http, part = _fields(head[:ends].split(b"\r\n")[1:]), head[ends + 4:]
            payload.update(part)
            out.payload_bytes += len(part)
            if self._keep:
                kept.append(part)
        for data in chunks:
            have += data
        if have != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} does not end where its Content-Length says")
        out.block_digest = base64.b32encode(block.digest()).decode()
        out.payload_digest = base64.b32encode(payload.digest()).decode()
        out.payload = b"".join(kept) if self._keep else None
        return out


def _bare(value: str | None) -> str | None:
    return value.removeprefix("sha1:") if value else None


def _read(batches: Iterable[pa.RecordBatch], keep_payload: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows, held = [], 0
            with reader(path) as stream:
                for r in Archive(stream, keep_payload):
                    h, kind = r.headers, r.headers.get("warc-type")
                    block, full = _bare(h.get("warc-block-digest")), _bare(h.get("warc-payload-digest"))
                    revisit = kind == "revisit"
                    size = int(r.http.get("content-length", r.payload_bytes)) if revisit else r.payload_bytes
                    good = (block in (None, r.block_digest)) and (revisit or full in (None, r.payload_digest))
                    rows.append((path, r.offset, h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-date"),
                                 size, full if revisit else r.payload_digest, h.get("warc-refers-to"), good, r.payload))
                    held += len(r.payload or b"") + 200
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in rows], schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in rows], schema)


def read(archives: DataFrame, path_col: str = "path", payloads: bool = False) -> DataFrame:
    """The records of ``archives`` (one path a row), each archive read in sequence by one
    task: path, offset of the member, record_id, record_type, target_uri, date,
    payload_bytes, payload_digest (bare base32 SHA-1), refers_to, digest_ok, payload (null
    unless ``payloads``).

    Length and digest are those of the bytes read; of a revisit, those that its headers
    give of the full payload. ``digest_ok`` is false if a digest in the headers is not that
    of the bytes. An HTTP message whose head has no end within ``HEAD_BYTES`` is all payload. A member that is cut off, without a header end or length, or whose block
    does not end where its length says, ends the job with its offset. No archives, no rows.
    """
    ship(archives.sparkSession)
    names = [("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
             ("target_uri", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("refers_to", pa.string()), ("digest_ok", pa.bool_()), ("payload", pa.binary())]
    ddl = ("path string, offset long, record_id string, record_type string, target_uri string, date string, "
           "payload_bytes long, payload_digest string, refers_to string, digest_ok boolean, payload binary")
    paths = archives.select(F.col(path_col).alias("path"))
    n = max(1, paths.count())
    return (paths.repartitionByRange(n, "path")
            .mapInArrow(partial(_read, keep_payload=payloads, schema=pa.schema(names)), ddl))


def page_id(record_id: Column) -> Column:
    """The id that ``write`` put into a record id (null for a row without one)."""
    found = F.regexp_extract(record_id, "^<urn:keepwell:page:(.*)>$", 1)
    return F.when((found != "") & (found != _NO_ID), found)
