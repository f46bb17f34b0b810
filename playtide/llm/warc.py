"""WARC archives: a writer, and a reader that salvages what damage leaves.

Every record is one gzip member. Records with equal payloads of at least ``REVISIT_BYTES``
bytes are revisits of the one with the smallest id. The writer hands finished members to
Spark's text sink, so archives have its commit protocol and any file system it knows: a
member ends with the top byte of its length, which is 0 below 16 MiB (an empty member is
added to longer ones), and that 0 is the sink's line separator.

The reader walks an archive from its start. A gzip member must inflate with the right
checksum and hold whole records; if it doesn't, its content, as far as it inflates, is
walked in the same way, its good records are kept, and what is lost inside is logged with the
member's place and the offsets in its content (where the stream is broken, and not only cut
short, a record needs a fitting SHA-256 block digest); a plain record must have a version line, its declared
length and its end mark; block digests must fit where they are given. Headers must have names that
are tokens. The writer puts a SHA-256 digest of the header lines behind them, which must fit where it
is given and makes the record ``proven``; without one a record must have a type, an id, a date and a length,
and is returned as not proven. After a failed check
it searches for the next gzip mark or version line at which all checks hold again, goes on
there, and logs the bytes between as a gap. The content of a broken member may lie in the archive as it
is (stored, not compressed); a record that was read from the member is not returned again there. Archives are read one per row, so they should be
of ordinary size (the writer's have the size of a shuffle partition, Spark's limit is 2 GB);
Spark deals them out to tasks.

Defined results: a null payload is empty. A null URL has no target header, a null id no
record id. Rows that repeat the smallest id of their payload are responses themselves.
Payloads may hold anything, version lines and gzip marks included. An empty table writes
archives without records, which read back as no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.llm.frames import map_texts, python_ready

REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"  # of records whose time is not known
BATCH_BYTES = 8 << 20  # of payload that the reader returns at once

# Fixed values of the format.
VERSION = b"WARC/1.0\r\n"
GZIP_MARK = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_START = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")
_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
_FIELDS = ("type", "record_id", "target", "refers_to", "payload_digest")
_HEADERS = ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest")

_NEEDED = ("warc-type", "warc-record-id", "warc-date")
_TOKEN = re.compile(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+")
_HEADER_DIGEST = "WARC-Header-Digest: sha256:"

RECORDS = ("path string, start bigint, stop bigint, reason string, type string, record_id string, target string, "
           "refers_to string, payload_digest string, proven boolean, payload binary")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; a revisit, without the payload, if it refers to another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: <urn:x-page:{page_id}>")
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SIGNS)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}",
              f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    lines.append(_HEADER_DIGEST + hashlib.sha256("\r\n".join(lines).encode()).hexdigest())
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SIGNS = "".join(chr(c) for c in range(33, 127) if chr(c) not in '"<>\\^`{|}')


def member(data: bytes) -> bytes:
    """A gzip member that ends with a zero byte."""
    packed = zlib.compress(data, 6, wbits=31)
    return packed if packed[-1] == 0 else packed + zlib.compress(b"", 6, wbits=31)


def marked_copies(pages: DataFrame, id_column: str = "page_id", url: str = "url",
                  payload: str = "html") -> DataFrame:
    """``id, url, payload, digest, refers_to``: which pages are revisits of which."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = (pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url}`").alias("url"), body.alias("payload"))
            .withColumn("digest", F.sha2("payload", 256)))
    first = (rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return (rows.join(first, "digest", "left")
            .withColumn("refers_to", F.expr("if(id = first, null, first)")).drop("first"))


def write(pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write the pages as archives of gzip members below ``path``."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(batch[name].to_pylist() for name in ("id", "url", "payload", "digest", "refers_to")))
        return pa.RecordBatch.from_arrays([pa.array([member(record(*row))[:-1] for row in rows], pa.binary())],
                                          names=["member"])

    members = map_texts(marked_copies(pages, id_column, url, payload), run, "member binary", "payload")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


class Damage(ValueError):
    """Why bytes are not a record, what was found in them nevertheless, and up to where they were read."""

    def __init__(self, reason: str, found: list[tuple] = (), stop: int = 0):
        super().__init__(reason)
        self.found, self.stop = found, stop


def parse(data: bytes | memoryview, start: int) -> tuple[dict, bytes, int]:
    """The headers and block of the record at ``start``, and where it stops."""
    if not _VERSION.match(data, start):
        raise Damage("no version line")
    head = re.compile(rb"\r\n\r\n").search(data, start)
    if not head:
        raise Damage("headers without an end")
    lines = bytes(data[start:head.start()]).split(b"\r\n")[1:]
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("a header line without a colon")
        if not _TOKEN.fullmatch(name.decode("latin-1")):
            raise Damage("a header name is not a token")
        headers[name.decode("latin-1").lower()] = value.decode("utf-8", "replace").strip()
    if proven(headers):
        if lines[-1] != (_HEADER_DIGEST + hashlib.sha256(b"\r\n".join(lines[:-1])).hexdigest()).encode():
            raise Damage("header digest differs")
    elif missing := [name for name in _NEEDED if name not in headers]:
        raise Damage(f"no {missing[0]}")
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damage("no content length")
    stop = head.end() + int(length)
    if bytes(data[stop:stop + 4]) != b"\r\n\r\n":
        raise Damage("no end mark after the block")
    block = bytes(data[head.end():stop])
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha256:") and digest[7:].lower() != hashlib.sha256(block).hexdigest():
        raise Damage("block digest differs")
    return headers, block, stop + 4


def proven(headers: dict) -> bool:
    """Whether the record's header lines have a digest, which fits if ``parse`` returned them."""
    return "warc-header-digest" in headers


def inflate(data: memoryview, start: int, chunk: int = 1 << 16) -> tuple[bytes, int, str | None, bool]:
    """The content of the gzip member at ``start``, where it stops, and what is wrong with it, if anything.

    Of a damaged member there is what inflates before the fault; the last value says whether it is
    surely right, as in a member that is only cut short.
    """
    engine, parts, at = zlib.decompressobj(wbits=31), [], start
    try:
        while not engine.eof:
            if at >= len(data):
                return b"".join(parts), len(data), "member without an end", True
            parts.append(engine.decompress(data[at:at + chunk]))
            at += chunk
    except zlib.error as error:
        # A failing call returns nothing: come to the same place again, and on by single bytes.
        engine = zlib.decompressobj(wbits=31)
        for before in range(start, at, chunk):
            engine.decompress(data[before:before + chunk])
        try:
            while at < len(data):
                parts.append(engine.decompress(data[at:at + 1]))
                at += 1
        except zlib.error:
            pass
        return b"".join(parts), at, f"member: {error}", False
    return b"".join(parts), min(at, len(data)) - len(engine.unused_data), None, True


def _plain_at(data: memoryview, start: int) -> tuple[list[tuple], int]:
    headers, block, stop = parse(data, start)
    return [(None, headers, block)], stop


def _records_at(data: memoryview, start: int) -> tuple[list[tuple], int]:
    """``reason, headers, block`` of the records at ``start`` and of the gaps between them, and where they stop."""
    if data[start:start + 3] != GZIP_MARK:
        return _plain_at(data, start)
    content, stop, fault, sure = inflate(data, start)
    found = []
    for first, last, reason, headers, block in _walk(memoryview(content), _plain_at, _VERSION):
        if reason is None and not sure and not headers.get("warc-block-digest", "").startswith("sha256:"):
            reason = "no digest proves the record of a broken member"
        found.append((f"content {first} to {last}: {reason}", {}, b"") if reason else (None, headers, block))
    good = any(reason is None for reason, *_ in found)
    if fault or (found and not good):
        raise Damage(fault or found[0][0], found if good else [], stop)
    return found, stop


def _walk(data: memoryview, read_at: Callable[[memoryview, int], tuple[list[tuple], int]],
          mark: re.Pattern) -> Iterator[tuple[int, int, str | None, dict, bytes]]:
    at, lost, reason = 0, None, ""
    held, held_until = set(), 0  # records of the last broken member, and where it was given up
    while at < len(data):
        if lost is None and data[at:at + 2] == b"\r\n":  # blank lines between records
            at += 2
            continue
        try:
            found, stop = read_at(data, at)
            damage, last = None, stop
            if at < held_until and data[at:at + 3] != GZIP_MARK:
                fresh = [row for row in found if row[0] or _same(row) not in held]
                if found and not fresh:
                    at = stop
                    continue
                found = fresh
        except Damage as error:
            following = mark.search(data, at + 1)
            found, stop, damage = error.found, following.start() if following else len(data), str(error)
            last = error.stop or stop
            if found:
                held, held_until = {_same(row) for row in found if row[0] is None}, last
        if lost is not None and (damage is None or found):
            yield lost, at, reason, {}, b""
            lost = None
        for why, headers, block in found:
            yield at, last, why, headers, block
        if damage is not None and lost is None:
            lost, reason = at, damage
        at = stop
    if lost is not None:
        yield lost, len(data), reason, {}, b""


def _same(row: tuple) -> tuple:
    _, headers, block = row
    return tuple(headers.items()), hashlib.sha256(block).digest()


def salvage(content: bytes) -> Iterator[tuple[int, int, str | None, dict, bytes]]:
    """``start, stop, reason, headers, block`` of each record, and of each gap (those with a reason)."""
    return _walk(memoryview(content), _records_at, _START)


def payload_of(headers: dict, block: bytes) -> bytes:
    """What follows the HTTP headers, where the block has them."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record and gap (the rows with a reason) of the archives below ``path``."""
    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for name, content in zip(batch["path"].to_pylist(), batch["content"]):
            for start, stop, reason, headers, block in salvage(content.as_py()):
                yield (name, start, stop, reason, *[headers.get(h) for h in _HEADERS],
                       None if reason else proven(headers), None if reason else payload_of(headers, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.string()] * len(_FIELDS), pa.bool_(), pa.binary()]
        names = ["path", "start", "stop", "reason", *_FIELDS, "proven", "payload"]
        for batch in batches:
            held, size = [], 0
            for row in rows(batch):
                held.append(row)
                size += len(row[-1] or b"") + 500
                if size > BATCH_BYTES:
                    yield _batch(held, kinds, names)
                    held, size = [], 0
            if held:
                yield _batch(held, kinds, names)

    python_ready(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RECORDS)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)


def records(read_rows: DataFrame) -> DataFrame:
    return read_rows.where("reason is null").drop("reason")


def gaps(read_rows: DataFrame) -> DataFrame:
    return read_rows.where("reason is not null").select("path", "start", "stop", "reason")
