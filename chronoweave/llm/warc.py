"""WARC archives of pages, written by Spark and read back by a salvage reader.

An archive is a row of records, each a gzip member of its own. The writer hands finished members
to Spark's text writer, so files are committed like any other table's and a lost executor's task
is simply run again. The reader streams a file record by record, checks each one, and where a
check fails searches for the next member or version line that holds; the bytes between are
reported as a quarantined gap and later records are recovered.
"""
from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.sources.file_stream import list_files, open_file

from ._common import utf8

VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

ARCHIVE_SCHEMA = ("path string, offset long, length long, kind string, reason string, record_type string, "
                  "record_id string, refers_to string, target_uri string, warc_date string, "
                  "payload_bytes long, payload_digest string, payload binary")


# ---- writing ------------------------------------------------------------------------------

def _gzip(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


EMPTY_MEMBER = _gzip(b"", 6)


def sha1_label(digest_hex: str) -> str:
    """The digest as archives label it: ``sha1:`` and base 32."""
    return "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()


def page_urn(page_id: int | None, digest_hex: str) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}:{digest_hex}>"


def format_record(page_id: int | None, url: str | None, payload: bytes, digest_hex: str, refers_to: int | None,
                  revisit: bool, date: str) -> bytes:
    """One record: a response with its HTTP header and payload, or a revisit with the HTTP header alone."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    head = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {page_urn(page_id, digest_hex)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if revisit:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {page_urn(refers_to, digest_hex)}"]
    head += [f"WARC-Payload-Digest: {sha1_label(digest_hex)}", f"WARC-Block-Digest: {sha1_label(hashlib.sha1(block).hexdigest())}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def write_archives(pages: DataFrame, root: str, *, key: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z", level: int = 6) -> None:
    """Write one record a page into archives under ``root``.

    Of pages whose payloads of at least ``least_bytes`` bytes are equal, the one with the largest
    key is a response and the others revisit it; all other pages are responses. A row that repeats
    that largest key and payload is a response, too. Null html is an empty payload. Null keys are
    smaller than all others; pages that share a payload under null keys only are all responses.
    Null URLs are left out of the record. Other columns are ignored. Empty table: empty archives.

    Only payloads of ``least_bytes`` or more travel, to meet their digest's largest key; a payload
    on a third of all pages is a skewed join key, which Spark splits.
    """
    base = pages.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u"), utf8(html).alias("p"))
    base = base.withColumn("d", F.sha1("p"))
    long_ = F.octet_length("p") >= least_bytes
    tops = base.where(long_).groupBy("d").agg(F.max("k").alias("top"), F.count(F.lit(1)).alias("n"))
    tops = tops.where("n > 1 AND top IS NOT NULL").select("d", "top")
    rows = (base.where(long_).join(tops, "d", "left").select("k", "u", "p", "d", "top")
            .unionByName(base.where(~long_).withColumn("top", F.lit(None).cast("long"))))

    def members(batches):
        for b in batches:
            out: list[bytes] = []
            size = 0
            cols = [b.column(i) for i in range(5)]
            for k, u, p, d, top in zip(*cols):
                k, top = k.as_py(), top.as_py()
                record = format_record(k, u.as_py(), p.as_py(), d.as_py(), top, top is not None and k != top, date)
                m = _gzip(record, level)
                # a member ends with the high byte of its length: zero below 16 MB, which Spark's line
                # separator writes; a longer record gets an empty member behind it, that ends with one
                m = m if m[-1] == 0 else m + EMPTY_MEMBER
                out.append(m[:-1])
                size += len(m)
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    (rows.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", "\u0000").option("compression", "none").text(root))


# ---- reading ------------------------------------------------------------------------------

class Damaged(Exception):
    """A check failed; the text names it."""


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes | None
    payload_bytes: int | None
    payload_digest: str | None


@dataclass
class Found:
    """A record, or a gap (``record`` is None) with the reason of its first failed check."""
    offset: int
    length: int
    record: Record | None = None
    reason: str | None = None


class _Window:
    """Reads anywhere in a file through one buffer."""

    def __init__(self, f, size: int, chunk: int = 1 << 20):
        self.f, self.size, self.chunk = f, size, chunk
        self.base, self.buf = 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if at < self.base or at + n > self.base + len(self.buf):
            self.f.seek(at)
            self.base, self.buf = at, self.f.read(max(n, self.chunk))
        i = at - self.base
        return self.buf[i:i + n]


@dataclass
class _Source:
    """Bytes of a stretch of the file from ``at``, as lines or by number."""
    window: _Window
    at: int
    held: bytes = b""
    used: int = 0
    step: int = 1 << 14

    def _more(self) -> bytes:
        x = self.window.get(self.at, self.step)
        self.at += len(x)
        return x

    def _fill(self, n: int) -> None:
        parts = [self.held[self.used:]]
        have = len(parts[0])
        while have < n:
            self.step = min(1 << 20, self.step * 2)
            x = self._more()
            if not x:
                break
            parts.append(x)
            have += len(x)
        self.held, self.used = b"".join(parts), 0

    def read(self, n: int) -> bytes:
        if len(self.held) - self.used < n:
            self._fill(n)
        out = self.held[self.used:self.used + n]
        self.used += len(out)
        return out

    def line(self, limit: int = 1 << 16) -> bytes:
        while True:
            i = self.held.find(b"\n", self.used)
            if i >= 0:
                break
            have = len(self.held) - self.used
            if have > limit:
                raise Damaged("header line too long")
            self._fill(have + 1)
            if len(self.held) - self.used == have:
                i = len(self.held) - 1
                break
        out = self.held[self.used:i + 1]
        self.used = i + 1
        return out

    def end(self) -> int:
        return self.at - (len(self.held) - self.used)


@dataclass
class _Member(_Source):
    """The inflated bytes of one gzip member. Its checksum and length are compared at its end, so
    that what inflated before a wrong one has been seen."""
    inflate: object = None
    crc: int = 0
    size: int = 0

    def _more(self) -> bytes:
        if self.inflate is None:
            self.at += _gzip_header(self.window.get(self.at, 1 << 16))
            self.inflate = zlib.decompressobj(-15)
        while not self.inflate.eof:
            raw = self.inflate.unconsumed_tail or super()._more()
            if not raw:
                raise Damaged("member cut off")
            try:
                out = self.inflate.decompress(raw, 1 << 20)
            except zlib.error as e:
                raise Damaged(f"member broken: {e}") from None
            if out:
                self.crc, self.size = zlib.crc32(out, self.crc), self.size + len(out)
                return out
        return b""

    def end(self) -> int:
        """File offset after the member, once all of it has been read and its trailer agrees."""
        if self.read(1):
            raise Damaged("bytes after the last record of a member")
        self.at -= len(self.inflate.unused_data)
        trailer = self.window.get(self.at, 8)
        if trailer != (self.crc | (self.size & 0xFFFFFFFF) << 32).to_bytes(8, "little"):
            raise Damaged("member checksum differs")
        return self.at + 8


def _gzip_header(data: bytes) -> int:
    """Length of the gzip header that ``data`` starts with."""
    if len(data) < 10 or data[2] != 8 or data[3] & 0xE0:
        raise Damaged("no member header")
    flags, at = data[3], 10
    if flags & 4:
        at += 2 + int.from_bytes(data[at:at + 2], "little")
    for named in (8, 16):  # a file name, a comment
        if flags & named:
            at = data.find(b"\0", at) + 1
            if not at:
                raise Damaged("no member header")
    return at + 2 * bool(flags & 2)


_VERSION_LINE = re.compile(rb"WARC/\d\.\d\r?\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r?\n[A-Za-z]")


def _digest(label: str) -> tuple[str, str] | None:
    """(algorithm, lower-case hex) of a digest header; None if it isn't one that can be checked."""
    name, _, value = label.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("sha1", "sha256", "sha512", "md5"):
        return None
    size = hashlib.new(name).digest_size
    value = value.strip()
    if re.fullmatch(r"[0-9a-fA-F]{%d}" % (2 * size), value):
        return name, value.lower()
    try:
        raw = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except ValueError:
        return None
    return (name, raw.hex()) if len(raw) == size else None


def _checked(label: str | None, data: bytes, what: str) -> None:
    want = _digest(label) if label else None
    if want and hashlib.new(want[0], data).hexdigest() != want[1]:
        raise Damaged(f"{what} digest differs")


def read_record(src: _Source) -> Record | None:
    """The record at the source's place, checked; None where the source ends."""
    line = src.line()
    if not line:
        return None
    if not _VERSION_LINE.fullmatch(line):
        raise Damaged("no version line")
    fields: dict[str, str] = {}
    last = None
    for _ in range(10_000):
        line = src.line()
        if not line.endswith(b"\n"):
            raise Damaged("header cut off")
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not text:
            break
        if text[0] in " \t" and last:
            fields[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        last = name.strip().lower()
        fields.setdefault(last, value.strip())
    else:
        raise Damaged("header without an end")
    if not fields.get("content-length", "").isdecimal():
        raise Damaged("no length")
    n = int(fields["content-length"])
    if n >= 1 << 31:
        raise Damaged("longer than a record can be")
    block = src.read(n)
    if len(block) < n:
        raise Damaged("block cut off")
    if src.read(4) != END:
        raise Damaged("no record end")
    _checked(fields.get("warc-block-digest"), block, "block")
    kind = fields.get("warc-type", "").lower()
    http = fields.get("content-type", "").lower().startswith("application/http")
    label = fields.get("warc-payload-digest")
    given = _digest(label) if label else None
    head, cut, payload = block.partition(END) if http else (b"", b"", block)
    if kind == "revisit":
        m = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", head if cut else block)
        return Record(fields, None, int(m[1]) if m and http else None, given[1] if given else None)
    if http and not cut:
        raise Damaged("no end of the HTTP header")
    _checked(label, payload, "payload")
    return Record(fields, payload, len(payload), hashlib.sha1(payload).hexdigest())


def _holds_start(window: _Window, at: int) -> bool:
    """Whether a member or version line really starts at a place that looks like one."""
    data = window.get(at, 1 << 14)
    if data.startswith(b"WARC/"):
        return True
    try:
        return _VERSION_LINE.match(zlib.decompressobj(31).decompress(data, 64)) is not None
    except zlib.error:
        return False


def next_start(window: _Window, at: int, step: int = 1 << 18) -> int:
    """The first place from ``at`` on where a member or version line starts; else the file's end."""
    while at < window.size:
        # not only at the beginning of a line: the record before may have lost its end
        for m in _START.finditer(window.get(at, step + 16)):
            place = at + m.start()
            if place < at + step and _holds_start(window, place):
                return place
        at += step
    return window.size


def salvage(f, size: int) -> Iterator[Found]:
    """Every good record of a file, and every gap between them, in file order.

    Gaps and records cover the file without overlap (records of one member share its bytes; empty
    members hold nothing). A
    record is good if its framing, its member's checksum and its digests, as far as it has them,
    are. A member of several records that breaks gives those that another one follows, as far as
    it inflates (to within a buffer); its gap is the whole member.
    """
    window = _Window(f, size)
    at, gap, why = 0, None, None
    while at < size:
        start, good, broken, end = at, [], None, at
        try:
            if window.get(at, 3) == b"\x1f\x8b\x08":
                src: _Source = _Member(window, at)
                while (r := read_record(src)) is not None:
                    if good:
                        yield from _closing(gap, start, why)
                        gap = None
                        yield Found(start, 0, good.pop())
                    good.append(r)
                end = src.end()
            else:
                src = _Source(window, at)
                good.append(read_record(src))
                end = src.end()
        except Damaged as e:
            broken = str(e)
        if broken is None:
            yield from _closing(gap, start, why)
            gap = None
            if good:
                yield Found(start, end - start, good[0])
            at = end
        else:
            if gap is None:
                gap, why = start, broken
            at = next_start(window, start + 1)
    yield from _closing(gap, size, why)


def _closing(gap: int | None, end: int, why: str | None) -> Iterator[Found]:
    if gap is not None and end > gap:
        yield Found(gap, end - gap, None, why)


def read_archives(spark: SparkSession, paths: list[str] | str, *, payload: bool = True) -> DataFrame:
    """Rows of every archive file under ``paths``: ``kind`` is ``record`` or ``gap``.

    Compressed members and plain records are both read, also mixed. A file is read by one task,
    which holds one or two records of it, whatever the file's size. A gap's row has the quarantined
    bytes' ``offset`` and ``length`` and the ``reason``; record columns are null. ``payload_digest``
    is a bare lower-case hex SHA-1, computed here for records with a payload and taken from the
    header for revisits; a revisit's ``payload_bytes`` is the length that its HTTP header states.
    ``payload=False`` leaves the payload null after all checks. Empty files give no row.
    """
    files = list_files(spark, paths).select("path", "length")

    def read(batches):
        names = [c.split()[0] for c in ARCHIVE_SCHEMA.split(", ")]
        schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]])
                            for n, c in zip(names, ARCHIVE_SCHEMA.split(", "))])
        for b in batches:
            for path, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows: list[tuple] = []
                size = 0
                with open_file(path) as f:
                    for x in salvage(f, length):
                        r = x.record
                        if r is None:
                            rows.append((path, x.offset, x.length, "gap", x.reason, *[None] * 8))
                        else:
                            h = r.fields.get
                            body = r.payload if payload else None
                            rows.append((path, x.offset, x.length, "record", None, h("warc-type"), h("warc-record-id"),
                                         h("warc-refers-to"), h("warc-target-uri"), h("warc-date"), r.payload_bytes,
                                         r.payload_digest, body))
                            size += len(body or b"")
                        if len(rows) >= 5000 or size > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return files.mapInArrow(read, ARCHIVE_SCHEMA)


def quarantined(archives: DataFrame) -> DataFrame:
    """The log of gaps: path, offset, length, reason."""
    return archives.where("kind = 'gap'").select("path", "offset", "length", "reason")


def page_records(archives: DataFrame) -> DataFrame:
    """Records of pages that :func:`write_archives` wrote: page_id, payload_bytes, payload_digest,
    record_type, refers_to (the response's page, for revisits)."""
    def page(col: str):
        return F.regexp_extract(col, r"^<urn:x-page:(none|-?\d+):", 1)

    def number(col: str):
        return F.when(page(col).isin("none", ""), None).otherwise(page(col)).cast("long")

    return (archives.where("kind = 'record'").where(page("record_id") != "")
            .select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    number("refers_to").alias("refers_to")))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS r FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
t AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM t
"""
