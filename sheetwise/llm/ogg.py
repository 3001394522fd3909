"""Media columns as Ogg: pages, lacing, checksums, logical streams and timestamps."""

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import slices, texts_of

#: Samples of a packet, and samples a second of the stored stream.
PACKET, RATE = 192, 8000
HEADER = struct.Struct("<4sBBqIIIB")
_FLIP = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))
CONTINUED, FIRST, LAST = 1, 2, 4


def page_checksum(page: bytes) -> int:
    """The Ogg checksum (polynomial 0x04C11DB7, high bit first, start 0) of a page whose checksum field is 0.

    zlib has the same polynomial low bit first: flip the bits of each byte, start from 0 and flip the result.
    """
    low_first = zlib.crc32(page.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(low_first.to_bytes(4, "little").translate(_FLIP), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = HEADER.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    crc = page_checksum(head + body)
    return head[:22] + struct.pack("<I", crc) + head[26:] + body


def _laced(packet: bytes) -> bytes:
    return b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])


def write_pages(packets: list[tuple[bytes, int]], serial: int) -> list[bytes]:
    """Pages of one logical stream from (packet, samples up to its end). The first packet has a page of its own; long packets go on over pages."""
    pages, number = [], 0
    groups = [packets[:1], packets[1:]] if len(packets) > 1 else [packets]
    for g, group in enumerate(groups):
        lacing = b"".join(_laced(p) for p, _ in group)
        body = b"".join(p for p, _ in group)
        ends = np.cumsum([len(p) // 255 + 1 for p, _ in group])
        done, at, carried = 0, 0, False
        for k in range(0, len(lacing), 255):
            part = lacing[k : k + 255]
            size = sum(part)
            stop = int(np.searchsorted(ends, k + len(part), side="right"))
            granule = group[stop - 1][1] if stop > done else -1
            flags = CONTINUED * carried | FIRST * (number == 0) | LAST * (g == len(groups) - 1 and k + 255 >= len(lacing))
            pages.append(_page(flags, granule, serial, number, part, body[at : at + size]))
            carried, done, at, number = part[-1] == 255, stop, at + size, number + 1
    return pages


def encode(payload: bytes) -> bytes:
    """An Ogg file of a payload: a stream of 8-bit samples in packets, and beside it a stream that notes the length.

    Serial numbers follow from the payload, so equal payloads give equal files.
    """
    serial = zlib.crc32(payload)
    samples = write_pages([(b"\x80pcm8" + struct.pack("<II", RATE, PACKET), 0)] + [(payload[i : i + PACKET], i + PACKET) for i in range(0, len(payload), PACKET)], serial)
    notes = write_pages([(b"\x80note", 0), (struct.pack("<Q", len(payload)), len(payload))], serial ^ 0x5A5A5A5A)
    # all first pages stand before any other
    return b"".join([samples[0], notes[0], *samples[1:-1], *notes[1:], samples[-1]])


def read_streams(data: bytes) -> tuple[dict[int, dict], int]:
    """Logical streams by serial number, and how many bytes failed.

    Each page's checksum is verified; after a bad one the search goes on at the next capture
    pattern. Packets are reassembled from lacing values, over pages where they continue; a packet
    with a page lost in its middle is left out and counted in `torn`. `granules` has the position
    of each page on which a packet ends.
    """
    streams: dict[int, dict] = {}
    at = bad = 0
    while at < len(data):
        if data[at : at + 4] == b"OggS" and at + 27 <= len(data):
            _, version, flags, granule, serial, number, crc, n = HEADER.unpack_from(data, at)
            lacing = data[at + 27 : at + 27 + n]
            size = 27 + n + sum(lacing)
            page = data[at : at + size]
            if version == 0 and len(lacing) == n and len(page) == size and page_checksum(page[:22] + b"\0\0\0\0" + page[26:]) == crc:
                s = streams.setdefault(serial, {"packets": [], "granules": [], "pages": 0, "open": None, "torn": 0, "next": number, "first": bool(flags & FIRST), "last": False})
                if number != s["next"] or bool(flags & CONTINUED) != (s["open"] is not None):
                    s["torn"] += s["open"] is not None
                    s["open"] = None
                skip = bool(flags & CONTINUED) and s["open"] is None
                body, packet = 27 + n, bytearray(s["open"] or b"")
                ended = False
                for lace in lacing:
                    packet += page[body : body + lace]
                    body += lace
                    if lace < 255:
                        if skip:
                            s["torn"] += 1
                        else:
                            s["packets"].append(bytes(packet))
                        packet, skip, ended = bytearray(), False, True
                s["open"] = bytes(packet) if n and lacing[-1] == 255 and not skip else None
                if ended and granule >= 0:
                    s["granules"].append(granule)
                s["pages"] += 1
                s["next"] = number + 1
                s["last"] |= bool(flags & LAST)
                at += size
                continue
        step = data.find(b"OggS", at + 1)
        step = len(data) if step < 0 else step
        bad += step - at
        at = step
    return streams, bad


def decode(data: bytes) -> tuple[bytes, str]:
    """The payload of an Ogg file of `encode`, and its features."""
    streams, bad = read_streams(data)
    payload, features = b"", []
    for serial in sorted(streams, key=lambda s: streams[s]["packets"][:1]):
        s = streams[serial]
        head = s["packets"][0] if s["packets"] else b""
        body = b"".join(s["packets"][1:])
        rate = struct.unpack_from("<I", head, 5)[0] if head.startswith(b"\x80pcm8") else RATE
        if head.startswith(b"\x80pcm8"):
            payload = body
        ms = [g * 1000 // rate for g in s["granules"]]
        features.append(f"{head[1:5].decode('ascii', 'replace')}:pages={s['pages']},packets={len(s['packets'])},bytes={len(body)},first_ms={ms[1] if len(ms) > 1 else 0},end_ms={max(ms, default=0)},torn={s['torn']},closed={int(s['last'])}")
    wave = np.frombuffer(payload, np.uint8)
    power = f"mean={wave.mean():.3f},peak={int(wave.max())}" if len(wave) else "mean=0.000,peak=0"
    return payload, ";".join([f"streams={len(streams)}", f"bad_bytes={bad}", *features, power])


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 8 << 20):
            media, sizes = [], []
            for text in texts_of(batch).cast(pa.large_binary()).to_pylist():
                size = max(PACKET, -(-len(text) // PACKET) * PACKET)
                media.append(encode(text.ljust(size)))
                sizes.append(len(text))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "media": pa.array(media, pa.binary())})


def _decode(batches: Iterator[pa.RecordBatch], digests: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "media", 8 << 20):
            rows = []
            for media in pc.fill_null(batch.column("media"), b"").to_pylist():
                payload, feature = decode(media)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, payload))
            parts = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "payload"]
            columns = {n: batch.column(n) for n in ("doc_id", "n_bytes")} | {n: pa.array(p, k) for n, p, k in zip(names, parts, kinds, strict=True)}
            if digests:
                columns.pop("payload")
            yield pa.RecordBatch.from_pydict(columns)


def store_ogg(docs: DataFrame) -> DataFrame:
    """A media column: the UTF-8 bytes of each whole text (null: empty), blank-padded to a positive multiple of 192, as an Ogg file.

    Rows: doc_id, n_bytes (unpadded), media. Row by row, without a shuffle: null and repeated
    doc_id, repeated rows and an empty table pass as they are, other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_encode, "doc_id long, n_bytes long, media binary")


def read_ogg(media: DataFrame, digests: bool = False) -> DataFrame:
    """Payload and features of each file of a media column (null: an empty file), read from the stored bytes.

    Damaged pages are skipped and counted in the feature; `digests` leaves the payload itself out.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", payload binary" * (not digests)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(lambda it: _decode(it, digests), schema)


def op7_ogg(spark, sf_dir: str) -> DataFrame:
    return read_ogg(store_ogg(spark.read.parquet(f"{sf_dir}/documents.parquet")), digests=True)
