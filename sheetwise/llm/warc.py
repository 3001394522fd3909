"""WARC archives: writing with revisit records, and a reader that salvages what is left of damaged ones."""

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .words import slices

MEMBER, VERSION = b"\x1f\x8b\x08", b"WARC/1.1\r\n"
DATE = "2000-01-01T00:00:00Z"
_HEAD = re.compile(rb"WARC/1\.[01]\r\n")
#: Headers that a record has once at most; repeated others are joined by ", ".
SINGLE = {"content-length", "content-type", "x-payload-length"} | {f"warc-{x}" for x in ("type", "record-id", "date", "target-uri", "payload-digest", "block-digest", "ip-address", "refers-to", "refers-to-target-uri", "refers-to-date", "profile", "truncated", "warcinfo-id", "filename", "identified-payload-type", "segment-number", "segment-origin-id", "segment-total-length")}


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit has no block; the digest and X-Payload-Length are always those of the full payload."""
    block = b"" if revisit else payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url or '')}", f"WARC-Payload-Digest: sha1:{base32(hashlib.sha1(payload).digest())}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with a fixed header, so that equal records give equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    return MEMBER + b"\0\0\0\0\0\0\xff" + z.compress(data) + z.flush() + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


@dataclass
class Salvaged:
    records: list[tuple[int, dict, bytes]] = field(default_factory=list)  # offset, headers, block
    gaps: list[tuple[int, int, str]] = field(default_factory=list)  # first byte, byte after, reason


def parse_record(data: bytes, at: int) -> tuple[dict, bytes, int] | str:
    """Headers, block and end of the record at `at`, or what is wrong with it."""
    head = _HEAD.match(data, at)
    if not head:
        return "no version line"
    stop = data.find(b"\r\n\r\n", head.end() - 2)
    if stop < 0:
        return "headers end nowhere"
    headers = {}
    for line in re.sub(rb"\r\n[ \t]+", b" ", data[head.end() : stop]).split(b"\r\n"):  # folded lines joined
        name, colon, value = line.partition(b":")
        if not colon:
            return "header without a colon"
        name = name.strip().lower().decode("utf-8", "replace")
        value = value.strip().decode("utf-8", "replace")
        if name in headers:
            if name in SINGLE:
                return "headers run into others"
            value = f"{headers[name]}, {value}"
        headers[name] = value
    size = headers.get("content-length", "")
    if not size.isdigit():
        return "no length"
    begin, end = stop + 4, stop + 4 + int(size)
    block = data[begin:end]
    if len(block) < int(size) or data[end : end + 4] != b"\r\n\r\n":
        return "cut off"
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != base32(hashlib.sha1(block).digest()):
        return "block digest differs"
    return headers, block, end + 4


#: Bytes that a member may unpack to; one with more (a decompression bomb) is quarantined.
MOST = 1 << 30


def _member(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int] | None:
    """A whole gzip member at `at` with its checksum right and at most MOST bytes in it, and its end."""
    z, parts, pos, size = zlib.decompressobj(31), [], at, 0
    try:
        while not z.eof and pos < len(data):
            parts.append(z.decompress(data[pos : pos + step]))
            pos, size = pos + step, size + len(parts[-1])
            if size > MOST:
                return None
    except zlib.error:
        return None
    return (b"".join(parts), min(pos, len(data)) - len(z.unused_data)) if z.eof else None


def salvage(data: bytes, members: bool = True) -> Salvaged:
    """All records of an archive, of gzip members or plain, that pass their checks.

    After a failed check the search goes on at the next byte where a whole member or a version
    line with a valid record stands; the bytes in between are logged as a gap. A whole member may hold
    several records: all have its offset, and if it has other bytes too the member is also logged as a gap.
    """
    found, at, lost, why = Salvaged(), 0, None, ""

    def bad(reason: str) -> None:
        nonlocal lost, why
        if lost is None:
            lost, why = at, reason

    def good() -> None:
        nonlocal lost
        if lost is not None:
            found.gaps.append((lost, at, why))
            lost = None

    while at < len(data):
        if members and data.startswith(MEMBER, at):
            got = _member(data, at)
            parsed = parse_record(got[0], 0) if got else "bad member"
            if not isinstance(parsed, str) and parsed[2] == len(got[0]):
                good()
                found.records.append((at, parsed[0], parsed[1]))
                at = got[1]
                continue
            inner = salvage(got[0], False) if got else Salvaged()
            if inner.records:
                good()
                found.records.extend((at, headers, block) for _, headers, block in inner.records)
                found.gaps.extend((at, got[1], reason) for _, _, reason in inner.gaps[:1])
                at = got[1]
                continue
            bad(parsed)
        elif data.startswith(b"WARC/1.", at):
            parsed = parse_record(data, at)
            if not isinstance(parsed, str):
                good()
                found.records.append((at, parsed[0], parsed[1]))
                at = parsed[2]
                continue
            bad(parsed)
        else:
            bad("no record starts here")
        spots = [p for p in (data.find(MEMBER, at + 1) if members else -1, data.find(b"WARC/1.", at + 1)) if p >= 0]
        at = min(spots, default=len(data))
    good()
    return found


def _archive(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "html", size):
            parts, at, starts = [], 0, []
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "first")]
            payloads = pc.fill_null(batch.column("html").cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()
            for page_id, url, first, payload in zip(*columns, payloads, strict=True):
                revisit = first is not None and page_id != first
                parts.append(member(record(page_id, url, payload, first if revisit else None, revisit)))
                starts.append(at)
                at += len(parts[-1])
            data = b"".join(parts)
            name = f"{hashlib.sha1(data).hexdigest()}.warc.gz"
            yield pa.RecordBatch.from_pydict({"path": pa.array([name]), "content": pa.array([data], pa.binary())})


def write_warc(pages: DataFrame, least: int = 0, archive_bytes: int = 8 << 20) -> DataFrame:
    """Archives (path, content) with one record for each page, payload its html in UTF-8 (null: empty).

    Of pages with equal payloads of at least `least` bytes the smallest page_id is a response and
    the others are revisits of it; pages with that very id, so also repeated rows, are all
    responses. A row with a null page_id is a revisit of the smallest page_id with its payload, and a response where
    no row with its payload has one. An empty table has no archive. Each archive holds the gzip members of up to
    `archive_bytes` of payload, so no task holds more than that or one page. Other columns are ignored.
    Payload digests are counted with partial sums and written; only digests met twice or more are joined
    back, and Spark can split the pages of a frequent one (such as all empty pages) in that join.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    big = rows.where(F.octet_length("html") >= least)
    first = big.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = Scratch(pages.sparkSession, "warc").put(first, "first").hint("merge")
    joined = rows.join(first, "digest", "left").select("page_id", "url", "html", "first")
    return joined.mapInArrow(lambda it: _archive(it, archive_bytes), "path string, content binary")


def _read(batches: Iterator[pa.RecordBatch], gaps: bool, payload: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for k in range(whole.num_rows):
            path, content = whole.column("path")[k].as_py(), whole.column("content")[k].as_py() or b""
            found = salvage(content)
            if gaps:
                yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(found.gaps), pa.string()), "first_byte": pa.array([g[0] for g in found.gaps], pa.int64()), "end_byte": pa.array([g[1] for g in found.gaps], pa.int64()), "reason": pa.array([g[2] for g in found.gaps], pa.string())})
                continue
            heads = [h for _, h, _ in found.records]
            ids = [re.search(r"<urn:page:(-?\d+)>", h.get("warc-record-id", "")) for h in heads]
            refs = [re.search(r"<urn:page:(-?\d+)>", h.get("warc-refers-to", "")) for h in heads]
            columns = {
                "path": pa.array([path] * len(heads), pa.string()), "at": pa.array([r[0] for r in found.records], pa.int64()),
                "page_id": pa.array([m and int(m[1]) for m in ids], pa.int64()), "url": pa.array([h.get("warc-target-uri") for h in heads], pa.string()),
                "payload_bytes": pa.array([int(h.get("x-payload-length") or len(r[2])) for h, r in zip(heads, found.records, strict=True)], pa.int64()),
                "payload_digest": pa.array([h.get("warc-payload-digest", "").removeprefix("sha1:") for h in heads], pa.string()),
                "record_type": pa.array([h.get("warc-type") for h in heads], pa.string()), "refers_to": pa.array([m and int(m[1]) for m in refs], pa.int64()),
            }
            if payload:
                columns["payload"] = pa.array([r[2] for r in found.records], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def read_warc(archives: DataFrame, payload: bool = True) -> DataFrame:
    """One row for each record that passes its checks, from a table (path, content) as `write_warc` or spark.read.format("binaryFile") gives it.

    Checked are gzip checksum, version line, headers, length and block digest. Empty or null
    content has no records.
    """
    schema = "path string, at long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payload
    return archives.select("path", "content").mapInArrow(lambda it: _read(it, False, payload), schema)


def quarantined(archives: DataFrame) -> DataFrame:
    """The byte gaps that `read_warc` passed over, with the reason of the first failed check; none for null or empty content and for an empty table, and each row's own for repeated paths."""
    return archives.select("path", "content").mapInArrow(lambda it: _read(it, True, False), "path string, first_byte long, end_byte long, reason string")


def op8_warc(spark, sf_dir: str) -> DataFrame:
    archives = Scratch(spark, "warc").put(write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet")), "archives")
    return read_warc(archives, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INT) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h
"""
