"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

Writer. Each row becomes one record, a gzip member of its own. Of the records with equal payloads of at
least ``min_payload`` bytes the one with the largest key is a ``response``; the others are ``revisit`` records that name it
and hold no payload. Equal payloads are found on digests, by a grouped aggregate that combines before its shuffle. Archives
are written by Spark itself, through whatever file system the path names: its text writer ends each row with a
separator, here a zero byte, which is exactly the last byte of a gzip member below 16 MiB (the
high byte of its size), so the rows are stored without it. A larger record goes on in further members, as gzip
allows. What Spark leaves is a folder of archives, each the plain concatenation of its members.

Salvage reader. Each archive is read from its start; a record may come as one or more gzip members or
uncompressed. It is accepted if the members inflate with their check sums, the version line, the headers and the
closing line are there, the block has its stated length, and block and payload digests (where given) agree. After a
failed check the reader searches, from the next byte on, for the next member or version line at
which a valid record starts; the bytes between are quarantined as one logged gap, and reading goes on. So a
damaged record costs itself only. Zero bytes between members are padding, not damage. A member that fails at its end
(bad check sum, or cut off) is searched inside as well: what follows it is found wherever it starts.

An archive is one cell of Spark's binary reader (below 2 GB), so a task holds an archive and one record at a time. ``archive_records`` bounds the records of an archive that the writer makes.

Edge cases: a null payload is empty; a null key is written as ``-`` and never refers or is referred to; rows that share the
largest key and the payload are all responses; a null url gives no target header, and control characters, spaces and ``<>`` in urls are percent
encoded; a text of any length is one record; an empty table gives a folder without records. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import map_arrow, to_arrow
from .words import slices

MEMBER = b"\x1f\x8b\x08"
CRLF = b"\r\n"
MEMBER_BYTES = 8 << 20  # a member inflates to this at most; below 16 MiB its last byte is zero
VERSION = re.compile(rb"WARC/1\.[0-9]{1,3}\r\n")
START = re.compile(rb"\x1f\x8b\x08|" + VERSION.pattern)
PADDING = re.compile(rb"\0+")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


@dataclass(frozen=True)
class Settings:
    min_payload: int = 1000
    archive_records: int = 20_000
    level: int = 6
    date: str = "2000-01-01T00:00:00Z"  # the tables have no time of capture
    id_prefix: str = "urn:page:"


# -- writer ----------------------------------------------------------------------

def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _target(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", url)


def record(key: str, url: str | None, payload: bytes, refers_to: str | None, s: Settings) -> bytes:
    """One uncompressed record: an HTTP response with the payload, or a revisit of one without it."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{s.id_prefix}{key}>"),
            ("WARC-Date", s.date)]
    if url is not None:
        head.append(("WARC-Target-URI", _target(url)))
    head.append(("WARC-Payload-Digest", _sha1(payload)))
    if refers_to is None:
        head.append(("WARC-Block-Digest", _sha1(block)))
    else:
        head += [("WARC-Refers-To", f"<{s.id_prefix}{refers_to}>"), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    told = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return b"WARC/1.1\r\n" + told + CRLF + block + CRLF + CRLF


def members(data: bytes, level: int = 6) -> bytes:
    """``data`` as gzip members, each of at most ``MEMBER_BYTES``."""
    out = []
    for at in range(0, len(data), MEMBER_BYTES):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += [z.compress(data[at:at + MEMBER_BYTES]), z.flush()]
    return b"".join(out)


def _revisited(pages: DataFrame, s: Settings) -> DataFrame:
    """Payloads that several keys share: ``sha``, ``bytes`` and the key of their response, ``top``."""
    light = pages.select("key", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("bytes"))
    light = light.filter((F.col("bytes") >= s.min_payload) & F.col("key").isNotNull())
    groups = light.groupBy("sha", "bytes").agg(F.max("key").alias("top"), F.min("key").alias("least"))
    return groups.filter("least < top").drop("least")


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
          s: Settings = Settings()) -> None:
    """Write a record per row as archives below ``path``."""
    given = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                         F.coalesce(F.col(payload).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    shared = _revisited(given, s)
    rows = given.withColumn("sha", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    rows = rows.join(shared, ["sha", "bytes"], "left")
    rows = rows.select(F.coalesce(F.col("key").cast("string"), F.lit("-")).alias("key"), "url", "payload",
                       F.when(F.col("key") < F.col("top"), F.col("top").cast("string")).alias("refers_to"))

    def run(batches):
        for b in (x for batch in batches for x in slices(batch, "payload", 4 << 20)):
            told = [members(record(k, u, p, r, s), s.level)[:-1] for k, u, p, r in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(told, pa.binary())], names=["member"])
    out = map_arrow(rows, run, "member binary").select(F.col("member").cast("string").alias("value"))
    (out.write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", s.archive_records)
     .text(path))


# -- salvage reader ----------------------------------------------------------------

@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    payload: bytes
    full_bytes: int  # of the whole payload; a revisit's own block states it


@dataclass
class Gap:
    """Bytes of an archive that belong to no valid record."""
    start: int
    end: int
    reason: str


class Bad(ValueError):
    """A failed check."""


def _inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """What the gzip member at ``at`` holds, and where it ends."""
    z = zlib.decompressobj(31)
    out, step, size = [], at, 1 << 14
    while not z.eof:  # pieces, so that the archive behind a small member is not copied each time
        piece = data[step:step + size]
        if not piece:
            raise Bad("member cut off")
        try:
            out.append(z.decompress(piece))
        except zlib.error as ex:
            raise Bad("member damaged") from ex
        step, size = step + len(piece), min(2 * size, 1 << 20)
    return b"".join(out), step - len(z.unused_data)


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("header without a colon")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _length(value: str | None) -> int:
    if not (value and value.isascii() and value.isdigit()) or len(value) > 12:
        raise Bad("no content length")
    return int(value)


def _agrees(name: str, stated: str | None, data: bytes) -> None:
    """Checks a stated SHA-1, in base 32 or hex; other digests are not checked."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() == "sha1":
        sha = hashlib.sha1(data)
        if value.upper() != base64.b32encode(sha.digest()).decode() and value.lower() != sha.hexdigest():
            raise Bad(f"{name} digest differs")


def _record_at(data: bytes, start: int) -> Record:
    """The valid record that starts at ``start``, or ``Bad``."""
    packed, base, after = data.startswith(MEMBER, start), start, start
    text: bytes | bytearray = data
    if packed:
        first, after = _inflated(data, start)
        text, base = bytearray(first), 0
    if not VERSION.match(text, base):
        raise Bad("no version line")
    close = text.find(b"\r\n\r\n", base, base + (1 << 16))
    if close < 0:
        raise Bad("headers not closed")
    headers = _fields(text[base:close].split(CRLF)[1:])
    body = close + 4
    end = body + _length(headers.get("content-length"))
    while packed and len(text) < end + 4 and data.startswith(MEMBER, after):
        more, after = _inflated(data, after)
        if VERSION.match(more):
            break  # the next record
        text += more
    if len(text) < end + 4:
        raise Bad("record cut off")
    if text[end:end + 4] != CRLF + CRLF or (packed and len(text) > end + 4):
        raise Bad("record not closed where its length says")
    block = bytes(text[body:end])
    _agrees("block", headers.get("warc-block-digest"), block)
    payload, full = block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        full = len(payload)
        if headers.get("warc-type") == "revisit":
            full = _length(_fields(http.split(CRLF)[1:]).get("content-length"))
    if headers.get("warc-type") != "revisit":
        _agrees("payload", headers.get("warc-payload-digest"), payload)
    return Record(start, after if packed else end + 4, headers, payload, full)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """The valid records of an archive, and gaps for all other bytes but padding, in order."""
    at, gap, reason = 0, -1, ""  # gap: where the open one starts
    while at < len(data):
        padding = PADDING.match(data, at) if gap < 0 else None
        if padding:
            at = padding.end()
            continue
        found, failed = None, "no record starts here"
        if START.match(data, at):
            try:
                found = _record_at(data, at)
            except Bad as ex:
                failed = str(ex)
        if found:
            if gap >= 0:
                yield Gap(gap, at, reason)
                gap = -1
            yield found
            at = found.end
            continue
        if gap < 0:
            gap, reason = at, failed
        nearest = START.search(data, at + 1)
        at = nearest.start() if nearest else len(data)
    if gap >= 0:
        yield Gap(gap, len(data), reason)


FOUND = ("archive string, start bigint, end bigint, reason string, record_id string, record_type string, refers_to string, "
         "target string, payload_digest string, payload_bytes bigint, payload binary")


def _row(archive: str, x: Record | Gap, payloads: bool) -> tuple:
    if isinstance(x, Gap):
        return (archive, x.start, x.end, x.reason, *[None] * 7)
    h = x.headers

    def bare(name: str) -> str | None:
        return h[name].strip("<>") if name in h else None
    digest = h.get("warc-payload-digest", "").partition(":")[2]
    digest = base64.b32decode(digest.upper()).hex() if len(digest) == 32 else digest.lower()
    return (archive, x.start, x.end, None, bare("warc-record-id"), h.get("warc-type"), bare("warc-refers-to"),
            h.get("warc-target-uri"), digest or hashlib.sha1(x.payload).hexdigest(), x.full_bytes,
            x.payload if payloads else None)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record and per gap of the archives below ``path``: ``archive``, ``start`` and ``end`` (bytes); of a gap
    its ``reason``; of a record ``record_id``, ``record_type``, ``refers_to``, ``target``, ``payload_digest`` (lower-case hex
    SHA-1) and ``payload_bytes`` of the full payload and, with ``payloads``, the ``payload`` that the record itself holds."""
    to = to_arrow(FOUND)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), to)], schema=to)

    def run(batches):
        for b in batches:
            for archive, content in zip(b.column("path").to_pylist(), b.column("content")):
                rows, size = [], 0
                for x in salvage(content.as_py()):
                    rows.append(_row(archive, x, payloads))
                    size += 256 + len(rows[-1][-1] or b"")
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, FOUND)


def round_trip(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type`` and ``refers_to``."""
    path = scratch_path(pages.sparkSession, "archives")
    kind = pages.schema["page_id"].dataType
    write(pages, path, s=s)

    def key(c: str) -> Column:
        k = F.substr(c, F.lit(len(s.id_prefix) + 1))
        return F.when(k != "-", k).cast(kind)
    return read(pages.sparkSession, path, payloads=False).filter("reason is null").select(
        key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", key("refers_to").alias("refers_to"))
