"""Operator 4: WARC archives, one gzip member per record, written and read by Spark tasks.

Reading is splittable: a task gets a byte range, scans it for the gzip magic,
validates a candidate by decoding the member's beginning (it must hold a WARC
version line), and owns the records whose member starts inside its range, to
whatever byte they extend.  From a record's end the next member usually follows
at once; after anything else the scan goes on.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_rows, sized, stage
from .files import list_files, open_file, write_bytes

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\x00"  # last byte of a member whose record is shorter than 16 MiB
#: An empty member: after it, a longer record's bytes end in END as well.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)

RECORD = ("record_id string, record_type string, refers_to string, target_uri string, "
          "payload_digest string, payload_bytes bigint, payload binary, file string, offset bigint")
_NAMES = [c.split()[0] for c in RECORD.split(", ")]


# ------------------------------------------------------------------ writing
def _member(data: bytes) -> bytes:
    out = gzip.compress(data, 6, mtime=0)
    return out if out[-1:] == END else out + EMPTY_MEMBER


def _line(value: str) -> str:
    """A header value cannot hold line breaks."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, uri: str | None, payload: bytes, sha1_hex: str, refers_to: str | None, date: str) -> bytes:
    """The bytes of a response record, or of a revisit record (headers of the response, no payload)."""
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC-Type: " + ("revisit" if refers_to is not None else "response"), f"WARC-Record-ID: <{_line(record_id)}>",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_line(uri)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_line(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(df: DataFrame, out: str, record_id: str, uri: str, payload: str, refers_to: str,
          date: str = "2026-01-01T00:00:00Z") -> None:
    """One record per row; ``payload`` (binary) may be null (empty); a row with ``refers_to`` becomes a revisit."""
    def make():
        def step(batch):
            rows = zip(*(c.to_pylist() for c in batch.columns))
            members = [_member(record(i, u, p or b"", hashlib.sha1(p or b"").hexdigest(), r, date))[:-1] for i, u, p, r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])
        return step

    cols = [F.col(record_id).cast("string"), F.col(uri).cast("string"), F.col(payload), F.col(refers_to).cast("string")]
    write_bytes(map_rows(df.select(*(c.alias(f"c{i}") for i, c in enumerate(cols))), "member binary", make, 64),
                "member", out, END)


# ------------------------------------------------------------------ reading
class _Source:
    """Forward reads of a file by 1 MiB blocks, able to go back within what is kept."""

    BLOCK = 1 << 20

    def __init__(self, f, at: int):
        self.f, self.base, self.buf = f, at, b""
        f.seek(at)

    def more(self) -> bool:
        block = self.f.read(self.BLOCK)
        self.buf += block
        return bool(block)

    def drop(self, at: int) -> None:
        """Forget what lies before ``at``."""
        self.buf, self.base = self.buf[at - self.base:], at

    def find_magic(self, at: int, end: int) -> int:
        """Where the next magic starts in [at, end), or -1."""
        while True:
            i = self.buf.find(MAGIC, at - self.base)
            if i >= 0:
                return self.base + i if self.base + i < end else -1
            at = max(at, self.base + len(self.buf) - 2)
            self.drop(at)
            if at >= end or not self.more():
                return -1


def _inflate(src: _Source, at: int, limit: int | None = None) -> tuple[bytes, int] | None:
    """The content of the member at ``at`` and where it ends; None if it is no whole member.

    With ``limit``, only that many bytes are decoded and the end is not sought.
    """
    d, out, pos, size = zlib.decompressobj(31), [], at, 0
    while True:
        i = pos - src.base
        if i >= len(src.buf) and not src.more():
            return None
        chunk = src.buf[i:i + src.BLOCK]
        try:
            got = d.decompress(chunk, (limit - size) if limit else 0)
        except zlib.error:
            return None
        out.append(got)
        size += len(got)
        pos += len(chunk) - len(d.unused_data) - len(d.unconsumed_tail)
        if d.eof or (limit and size >= limit):
            return b"".join(out), pos


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (names in lower case) and block of a record, or None if it is none."""
    if not data.startswith(b"WARC/1."):
        return None
    head, mark, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    try:
        n = int(headers.get("content-length", ""))
    except ValueError:
        return None
    return (headers, rest[:n]) if mark and 0 <= n <= len(rest) else None


def records(uri: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records whose member starts in [start, end)."""
    with open_file(uri) as f:
        src, at = _Source(f, start), start
        while (at := src.find_magic(at, end)) >= 0:
            src.drop(at)
            probe = _inflate(src, at, 7)
            whole = _inflate(src, at) if probe and probe[0] in (b"", b"WARC/1.") else None
            if whole is None:
                at += 1
                continue
            if found := parse(whole[0]):
                yield at, *found
            elif whole[0]:
                at += 1
                continue
            at = whole[1]


def _row(uri: str, at: int, headers: dict[str, str], block: bytes) -> tuple:
    kind = headers.get("warc-type")
    payload, length = block, None
    if "http" in headers.get("content-type", "").lower():
        http, _, payload = block.partition(b"\r\n\r\n")
        for line in http.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                length = int(value)
    digest = headers.get("warc-payload-digest", "")
    if digest.lower().startswith("sha1:") and len(digest) == 37:
        digest = base64.b32decode(digest[5:].upper()).hex()
    clean = lambda name: headers[name].strip("<>") if name in headers else None
    size = length if kind == "revisit" and length is not None else len(payload)
    return (clean("warc-record-id"), kind, clean("warc-refers-to"), headers.get("warc-target-uri"), digest or None, size,
            None if kind == "revisit" else payload, uri, at)


def read(spark: SparkSession, path: str, range_bytes: int = 8 << 20) -> DataFrame:
    """One row per record of the archives below ``path``, by byte ranges of ``range_bytes``.

    Bytes that belong to no whole record are passed over.
    """
    def make():
        def step(batch):
            for uri, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                held, size = [], 0
                for r in records(uri, lo, hi):
                    held.append(_row(uri, *r))
                    size += len(r[2])
                    if size > 4 << 20 or len(held) >= 512:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)
        return step

    files = list_files(spark, path).filter("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("lo"),
                          "length").select("path", "lo", F.least(F.col("lo") + range_bytes, "length").alias("hi"))
    n = max(1, spark.sparkContext.defaultParallelism)
    return map_rows(ranges.repartition(4 * n, "path", "lo"), RECORD, make, 1)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _NAMES)


# -------------------------------------------------------------------- pages
def page_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """pages with ``payload`` and ``refers_to``: of equal payloads of ``min_bytes`` or more, the
    row with the largest page_id stays a response, the others refer to it.

    Only ids and digests are shuffled to find them; the list of revisits is
    broadcast when its counted size allows, else joined by page_id.  A null html
    is an empty payload.  Rows with the largest page_id of their payload are all
    responses; a null page_id is never referred to and always a response.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    key = rows.filter((F.octet_length("payload") >= min_bytes) & F.col("page_id").isNotNull()).select(
        "page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"))
    key = stage(key, "warc-digests")
    first = (key.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low"))
                .filter("low < refers_to").select("digest", "size", "refers_to"))
    again = stage(key.join(first, ["digest", "size"]).filter("page_id < refers_to")
                     .select("page_id", "digest", "refers_to").distinct(), "warc-revisits")
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= min_bytes, F.sha2("payload", 256)))
    return rows.join(sized(again, 112), ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")


def archive_pages(pages: DataFrame, path: str, min_bytes: int = 1000) -> None:
    """Write ``pages`` (page_id, url, html; other columns are left out) as WARC files below ``path``."""
    rows = page_records(pages, min_bytes)
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    write(rows.select(name("page_id").alias("id"), "url", "payload",
                      F.when(F.col("refers_to").isNotNull(), name("refers_to")).alias("refers_to")),
          path, "id", "url", "payload", "refers_to")


def pages_from(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every archived page.

    A response's digest and length are those of the payload as read.
    """
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1).try_cast("bigint")
    r = read(spark, path)
    return r.select(number("record_id").alias("page_id"), "payload_bytes",
                    F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"),
                    "record_type", number("refers_to").alias("refers_to"))
