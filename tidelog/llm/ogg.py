"""Media columns: payloads as 8-bit samples in an Ogg container, and back.

Writing: each payload becomes one logical stream of 8-bit unsigned PCM (a header packet, then packets of samples), with a
second logical stream of text comments interleaved, cut into pages with lacing values and page checksums. Reading: every
page's checksum is verified, packets are reassembled from lacing values across pages, logical streams are told apart by
serial number, and the start and end of every packet follow from granule positions: a page's position is the end of the
last packet that ends in it, and the packets before it end their own samples earlier.

Null and empty texts have a payload of 64 zero bytes. A null medium gives nulls, a damaged one nulls and what is wrong with
it; neither stops the others. Rows are independent, so repeated rows give repeated results and an empty table an empty
one; other columns, whatever their names, are ignored. Of the loudest packets the first is named. Very long texts take as
many pages as they need; memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import column_of, raw, slices, texts

BLOCK = 64
RATE = 8000
PACKET = 4000
#: Rows that are read at once.
ROWS = 256
CONTINUED, FIRST, LAST = 1, 2, 4
_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_crc(page: bytes) -> int:
    """CRC-32 of polynomial 0x04c11db7, first bit first, start and end 0: the mirror image of zlib's."""
    mirrored = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = b"OggS\0" + struct.pack("<BqII", flags, granule, serial, number)
    rest = bytes([len(lacing)]) + lacing + body
    return head + page_crc(head + bytes(4) + rest).to_bytes(4, "little") + rest


def pages(packets: list[tuple[bytes, int]], serial: int) -> list[bytes]:
    """Pages of one logical stream. packets: data and the granule position at its end; the first has a page of its own."""
    out, lacing, body, granule, continued = [], [], [], -1, False

    def flush(last: bool) -> None:
        nonlocal lacing, body, granule, continued
        flags = CONTINUED * continued | FIRST * (not out) | LAST * last
        out.append(_page(flags, granule, serial, len(out), bytes(lacing), b"".join(body)))
        continued = bool(lacing) and lacing[-1] == 255
        lacing, body, granule = [], [], -1

    for k, (data, at) in enumerate(packets):
        sizes = [255] * (len(data) // 255) + [len(data) % 255]
        begin = 0
        while sizes:
            own, sizes = sizes[: 255 - len(lacing)], sizes[255 - len(lacing) :]
            end = begin + sum(own)
            lacing += own
            body.append(data[begin:end])
            begin = end
            if not sizes:
                granule = at
            if k == len(packets) - 1 and not sizes:
                flush(True)
            elif len(lacing) == 255 or k == 0 and not sizes:
                flush(False)
    return out


@dataclass
class Stream:
    """A logical stream read back: packets, and of each page that ends one, how many have ended and its granule position."""

    packets: list[bytes] = field(default_factory=list)
    granules: list[tuple[int, int]] = field(default_factory=list)
    ended: bool = False


class Damaged(ValueError):
    """A container whose pages don't hold together."""


def read(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number; raises Damaged on a wrong checksum, order, lacing or end."""
    streams: dict[int, Stream] = {}
    parts: dict[int, list[bytes]] = {}
    numbers: dict[int, int] = {}
    i = 0
    while i < len(data):
        if data[i : i + 5] != b"OggS\0" or i + 27 > len(data):
            raise Damaged(f"no page at byte {i}")
        flags, granule, serial, number, crc, n = struct.unpack_from("<BqIIIB", data, i + 5)
        lacing = data[i + 27 : i + 27 + n]
        end = i + 27 + n + sum(lacing)
        if len(lacing) < n or end > len(data):
            raise Damaged(f"page at byte {i} is cut off")
        if page_crc(data[i : i + 22] + bytes(4) + data[i + 26 : end]) != crc:
            raise Damaged(f"wrong checksum of the page at byte {i}")
        s = streams.setdefault(serial, Stream())
        open_part = parts.setdefault(serial, [])
        if number != numbers.get(serial, 0) or s.ended or bool(flags & FIRST) != (number == 0) or bool(flags & CONTINUED) != bool(open_part):
            raise Damaged(f"page at byte {i} is out of order")
        numbers[serial] = number + 1
        at = i + 27 + n
        # a packet ends at the first lacing value below 255
        begin, ended = at, False
        for size in lacing:
            at += size
            if size < 255:
                open_part.append(data[begin:at])
                s.packets.append(b"".join(open_part))
                open_part.clear()
                begin, ended = at, True
        if at > begin or lacing and lacing[-1] == 255:
            open_part.append(data[begin:at])
        if ended != (granule >= 0):
            raise Damaged(f"page at byte {i} has a position without a packet's end, or none with one")
        if granule >= 0:
            s.granules.append((len(s.packets), granule))
        s.ended = bool(flags & LAST)
        i = end
    if any(parts.values()) or not all(s.ended for s in streams.values()):
        raise Damaged("a stream doesn't end")
    return streams


def pad(payload: bytes) -> bytes:
    """Zero bytes up to a positive multiple of BLOCK."""
    return payload + bytes(-len(payload) % BLOCK if payload else BLOCK)


def write(payload: bytes) -> bytes:
    """The container of a payload whose length is a positive multiple of BLOCK. Equal payloads, equal bytes."""
    serial = zlib.crc32(payload) & 0x7FFFFFFF
    head = b"PCM     " + struct.pack(">HHIIBBHI", 0, 0, 1, RATE, 8, 1, PACKET, 0)
    sound = [(head, 0)] + [(payload[i : i + PACKET], min(i + PACKET, len(payload))) for i in range(0, len(payload), PACKET)]
    notes = [(b"notes\0" + struct.pack("<I", RATE), 0), (f"samples={len(payload)}".encode(), len(payload))]
    a, b = pages(sound, serial), pages(notes, serial ^ 0x80000000)
    return b"".join([a[0], b[0], b[1], *a[1:]])


def packet_times(stream: Stream, first: int = 1) -> list[tuple[int, int]]:
    """Samples at which each packet from number `first` on begins and ends, by the granule positions of the pages."""
    out: list[tuple[int, int]] = []
    done = 0
    for count, granule in stream.granules:
        end, own = granule, []
        for p in reversed(stream.packets[max(done, first) : count]):
            own.append((end - len(p), end))
            end -= len(p)
        out += reversed(own)
        done = count
    if done != len(stream.packets) or any(a[1] != b[0] for a, b in zip([(0, 0), *out], out, strict=False)):
        raise Damaged("granule positions don't fit the packets")
    return out


def payload_of(streams: dict[int, Stream]) -> tuple[bytes, list[tuple[float, float]]]:
    """The samples of the sound stream among the streams read, and the seconds at which each packet begins and ends."""
    sound = [s for s in streams.values() if s.packets and s.packets[0][:8] == b"PCM     "]
    if len(sound) != 1:
        raise Damaged(f"{len(sound)} sound streams")
    if len(sound[0].packets[0]) < 20 or not (rate := struct.unpack_from(">I", sound[0].packets[0], 16)[0]):
        raise Damaged("no rate in the header")
    return b"".join(sound[0].packets[1:]), [(a / rate, b / rate) for a, b in packet_times(sound[0])]


def feature(samples: bytes, times: list[tuple[float, float]]) -> str:
    """Seconds, mean, root mean square about the middle, crossings of the middle, packets, and when the loudest begins."""
    x = np.frombuffer(samples, np.uint8)
    n = np.bincount(x, minlength=256)
    v = np.arange(256) - 128
    high = x >= 128
    power = np.concatenate([[0], np.cumsum((v * v)[x])])
    cut = np.minimum(np.arange(len(times) + 1) * PACKET, len(x))
    loud = int(np.argmax(np.diff(power[cut]) / np.diff(cut)))
    return f"s={times[-1][1]:.6f};mean={float(n @ v) / len(x):.6f};rms={(float(n @ (v * v)) / len(x)) ** 0.5:.6f};cross={int((high[1:] != high[:-1]).sum())};packets={len(times)};loudest={times[loud][0]:.6f}"


def to_ogg(docs: DataFrame, column: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: each text of the column as an Ogg container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, column):
            data, at = raw(texts(column_of(b, column)))
            media = [write(pad(data[i:j].tobytes())) for i, j in zip(at.tolist(), at[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(np.diff(at)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", column).mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def from_ogg(media: DataFrame) -> DataFrame:
    """Digests of payload and container, a feature, and what is wrong, of each row of media(doc_id, n_bytes, media)."""

    def judged(stored: bytes | None) -> tuple:
        if stored is None:
            return (None,) * 7
        sha = lambda x: hashlib.sha256(x).hexdigest()
        try:
            payload, times = payload_of(read(stored))
            if not payload:
                raise Damaged("no samples")
        except Damaged as e:
            return None, None, None, len(stored), sha(stored), None, str(e)
        return len(payload), sha(payload), zlib.crc32(payload[-BLOCK:]), len(stored), sha(stored), feature(payload, times), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error"]
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS):
                b = whole.slice(i, ROWS)
                rows = [judged(x.as_py()) for x in column_of(b, "media")]
                yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), column_of(b, "n_bytes"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names)

    kind = media.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, out)
