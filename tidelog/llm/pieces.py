"""SentencePiece encoding that keeps source offsets, and decoding.

Texts are normalised by longest-prefix matches through the model's compiled character map (a double-array trie over
UTF-8, followed by its replacement strings); each normalised byte remembers the source bytes it came from. Stretches that
no key of the map starts in are copied by array operations, and a model without a map is one such stretch. The normalised
text is cut where no piece of the vocabulary can span the cut, each distinct chunk is encoded once by the library on an
identity-normalised copy of the model, and every piece is projected back to a byte span of the source through the
alignment. All results, ids, digests and spans, come from this one path.

A piece's span runs from the source of its first normalised byte to that of its last: a byte piece has its own byte where
the character is unchanged, else all bytes that were replaced; the blank put before a text has an empty span. Null and
empty texts have no pieces and decode to the empty text. Rows are independent, so repeated rows give repeated results and
an empty table an empty one; other columns, whatever their names, are ignored. There are no ties: the library's own order
of merges decides. Very long texts are worked on whole; memory follows the longest one. Models with user-defined symbols
are refused, as they would change the longest-prefix rule.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ._text import column_of, distinct, raw, slices, texts

#: Distinct chunks a worker keeps.
DICTIONARY = 100_000
#: Bytes of text that are worked on at once, unless a single text is longer; alignments take some 50 bytes for each.
STEP = 1 << 18
SPACE = "▁"
MARK = SPACE.encode()
BYTE, USER_DEFINED, CONTROL, UNKNOWN = 6, 4, 3, 2


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        c = b[i]
        i += 1
        out |= (c & 127) << shift
        shift += 7
        if c < 128:
            return out, i


def fields(b: bytes) -> Iterator[tuple[int, object, bytes]]:
    """Number, value and whole encoding of each field of a protocol-buffer message."""
    i = 0
    while i < len(b):
        began = i
        key, i = _varint(b, i)
        wire = key & 7
        if wire == 0:
            value, i = _varint(b, i)
        else:
            n, i = _varint(b, i) if wire == 2 else (8 if wire == 1 else 4, i)
            value, i = b[i : i + n], i + n
        yield key >> 3, value, b[began:i]


class CharacterMap:
    """Longest-prefix replacement through a compiled map; without one, every character stays."""

    def __init__(self, blob: bytes):
        self.units, self.strings = (), b""
        if blob:
            n = struct.unpack("<I", blob[:4])[0]
            self.units = struct.unpack(f"<{n // 4}I", blob[4 : 4 + n])
            self.strings = blob[4 + n :]

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def starts(self) -> np.ndarray:
        """Of each byte, whether a key starts with it."""
        out = np.zeros(256, bool)
        for c in range(256 if self.units else 0):
            at = self._jump(self.units[0]) ^ c
            out[c] = at < len(self.units) and self.units[at] & 0x800000FF == c
        return out

    def longest(self, b: bytes, i: int, end: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that starts at b[i] and ends before `end`."""
        found, at = None, self._jump(self.units[0])
        for k in range(i, end):
            at ^= b[k]
            if at >= len(self.units) or self.units[at] & 0x800000FF != b[k]:
                break
            unit = self.units[at]
            at ^= self._jump(unit)
            if unit >> 8 & 1:
                found = k + 1 - i, self.units[at] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]


class Aligned(NamedTuple):
    """Normalised bytes of many texts, the source bytes that each came from, and where the texts begin in both."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    at: np.ndarray
    source_at: np.ndarray


class Pieces(NamedTuple):
    """Distinct chunks, and where the chunks of many texts are among them."""

    names: pa.Array  # ids of each distinct chunk, as text
    sizes: pa.Array  # normalised bytes of each of its pieces
    decoded: pa.Array  # bytes
    where: np.ndarray
    bounds: np.ndarray  # first chunk of each text


class Codec:
    """Encodes and decodes whole texts with one model file."""

    def __init__(self, model: bytes, dictionary: int = DICTIONARY):
        from sentencepiece import SentencePieceProcessor

        spec, rest, self.surface, self.kinds = {}, [], [], []
        for number, value, whole in fields(model):
            if number == 3:
                spec = {k: v for k, v, _ in fields(value)}
            else:
                rest.append(whole)
            if number == 1:
                piece = {k: v for k, v, _ in fields(value)}
                self.surface.append(piece[1].decode())
                self.kinds.append(piece.get(3, 1))
        if USER_DEFINED in self.kinds:
            raise ValueError("models with user-defined symbols aren't supported")
        self.map = CharacterMap(spec.get(2, b""))
        self.key_starts = self.map.starts()
        self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        # the same model, whose normaliser neither maps, prefixes nor squeezes
        plain = b"\x0a\x08identity\x18\x00\x20\x00\x28\x01"
        self.lib = SentencePieceProcessor(model_proto=b"".join(rest) + b"\x1a" + bytes([len(plain)]) + plain)
        self.bytes_of = [bytes([int(s[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else s.replace(SPACE, " ").encode() for s, k in zip(self.surface, self.kinds, strict=True)]
        #: normalised bytes that a piece stands for; unknown ones are asked from the library
        self.size_of = [1 if k == BYTE else -1 if k == UNKNOWN else len(s.encode()) for s, k in zip(self.surface, self.kinds, strict=True)]
        normal = [s for s, k in zip(self.surface, self.kinds, strict=True) if k not in (BYTE, CONTROL, UNKNOWN)]
        #: no piece holds a space mark after another character
        self.by_space = all(SPACE not in s.lstrip(SPACE) for s in normal) and SPACE in normal
        self.apart = np.zeros((256, 256), bool)  # pairs of ASCII characters that stand together in no piece
        if self.by_space and BYTE in self.kinds:
            self.apart[:128, :128] = True
            for s in normal:
                for a, b in zip(s, s[1:], strict=False):
                    if a < "\x80" and b < "\x80":
                        self.apart[ord(a), ord(b)] = False
        self.dictionary, self.known = dictionary, {}

    def normalise(self, column: pa.Array) -> Aligned:
        """All texts of a large_string column, normalised, with their alignment."""
        data, at = raw(column)
        begin, end, source_at = np.arange(len(data)), np.arange(1, len(data) + 1), at
        if self.map.units:
            data, begin, end, at = self._mapped(data, at)
        if self.squeeze and len(data):
            blank = data == 32
            first = np.zeros(len(data), bool)
            first[at[:-1][np.diff(at) > 0]] = True
            keep = ~(blank & (first | np.concatenate([[False], blank[:-1]])))
            for i, j in zip(at.tolist(), at[1:].tolist(), strict=False):
                while j > i and (not keep[j - 1] or data[j - 1] in (32, MARK[-1])):
                    n = 1 if not keep[j - 1] or data[j - 1] == 32 else len(MARK)
                    if n > 1 and data[j - n : j].tobytes() != MARK:
                        break
                    keep[j - n : j] = False
                    j -= n
            count = np.concatenate([[0], np.cumsum(keep)])
            data, begin, end, at = data[keep], begin[keep], end[keep], count[at]
        # blanks become marks, and a mark of its own goes before each text that isn't empty
        heads = at[:-1][np.diff(at) > 0] if self.prefix else np.zeros(0, np.int64)
        size = np.where(data == 32, len(MARK), 1)
        size[heads] += len(MARK)
        where = np.repeat(np.arange(len(data)), size)
        place = np.concatenate([[0], np.cumsum(size)])
        out, begin, end = data[where], begin[where], end[where]
        for k, c in enumerate(MARK):
            out[place[heads] + k] = c
            end[place[heads] + k] = begin[place[heads] + k]
        blanks = place[1:][data == 32] - len(MARK)
        for k, c in enumerate(MARK):
            out[blanks + k] = c
        return Aligned(out, begin, end, place[at], source_at)

    def _mapped(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, alignment and offsets after replacement of the longest keys, from left to right."""
        whole, past, hits = data.tobytes(), 0, []
        ends = at[1:][np.searchsorted(at[1:], np.flatnonzero(self.key_starts[data]), "right")] if len(data) else []
        for i, stop in zip(np.flatnonzero(self.key_starts[data]).tolist(), ends, strict=True):
            if i >= past and (hit := self.map.longest(whole, i, int(stop))):
                past = i + hit[0]
                hits.append((i, past, hit[1]))
        parts, begins, finishes, grown, done = [], [], [], np.zeros(len(data) + 1, np.int64), 0
        for i, j, to in [*hits, (len(data), len(data), b"")]:
            own = np.arange(done, i)
            parts += [data[done:i], np.frombuffer(to, np.uint8)]
            begins += [own, np.full(len(to), i)]
            finishes += [own + 1, np.full(len(to), j)]
            grown[j] += len(to) - (j - i)
            done = j
        return np.concatenate(parts), np.concatenate(begins), np.concatenate(finishes), at + np.cumsum(grown)[at]

    def _chunk(self, text: str, ids: list[int]) -> tuple[str, bytes, bytes]:
        """Ids as text, the pieces' sizes as 32-bit numbers, decoded bytes: small, as workers keep many."""
        sizes = [self.size_of[i] for i in ids]
        if -1 in sizes:  # unknown characters in a row are one piece
            sizes = [n if n >= 0 else len(t.encode()) for n, t in zip(sizes, self.lib.encode(text, out_type=str), strict=True)]
        return ",".join(map(str, ids)), struct.pack(f"<{len(sizes)}i", *sizes), b"".join([self.bytes_of[i] for i in ids])

    def chunks(self, normal: Aligned) -> Pieces:
        """The chunks of normalised texts: each distinct one is encoded once, while the dictionary holds it."""
        data, at = normal.data, normal.at
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        if self.by_space and len(data):
            mark = np.zeros(len(data) + 3, bool)
            mark[3:-2] = (data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])
            cut[:-1] |= mark[3:] & ~mark[:-3]
            cut[1:-1] |= self.apart[data[:-1], data[1:]]
        starts = np.flatnonzero(cut)
        some, where = distinct(data, starts) if len(data) else ([], np.zeros(0, np.int64))
        some = [b.decode() for b in some]
        if len(self.known) > self.dictionary:
            self.known = {}
        known = self.known
        new = [t for t in some if t not in known]
        if new:
            known.update(zip(new, map(self._chunk, new, self.lib.encode(new, num_threads=1)), strict=True))
        names, sizes, decoded = zip(*(known[t] for t in some), strict=True) if some else ((), (), ())
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in sizes], dtype=np.int64)]) // 4
        lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(sizes), "<i4")))
        return Pieces(pa.array(names, pa.string()), lists, pa.array(decoded, pa.binary()), where, np.searchsorted(starts, at))

    def spans(self, normal: Aligned, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source bytes at which each piece begins and ends in its text, and the first piece of each text."""
        taken = pieces.sizes.take(pa.array(pieces.where))
        upto = np.concatenate([[0], np.cumsum(taken.flatten().to_numpy(), dtype=np.int64)])
        first = taken.offsets.to_numpy()[pieces.bounds] - taken.offsets.to_numpy()[0] if len(taken) else np.zeros(len(normal.at), np.int64)
        base = np.repeat(normal.source_at[:-1], np.diff(first))
        return normal.begin[upto[:-1]] - base, normal.end[upto[1:] - 1] - base, first

    @staticmethod
    def _joined(values: pa.Array, pieces: Pieces, gap: str | bytes) -> list:
        """The chunks' values of each text, put together."""
        lists = pa.ListArray.from_arrays(pa.array(pieces.bounds, pa.int32()), values.take(pa.array(pieces.where)))
        return pc.binary_join(lists, pa.scalar(gap, values.type)).to_pylist()

    def _decoded(self, b: bytes) -> str:
        # the space that stands for the prefix goes; bytes that are no UTF-8 give one replacement character each
        b = b[1:] if (self.prefix or self.squeeze) and b[:1] == b" " else b
        try:
            return b.decode()
        except UnicodeDecodeError:
            out, i = [], 0
            while i < len(b):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(b[i : i + n].decode())
                        break
                    except UnicodeDecodeError:
                        n = 0
                if not n:
                    out.append("�")
                i += n or 1
            return "".join(out)

    def encode(self, column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces, their spans, and the first piece of each text, of a large_string column."""
        normal = self.normalise(column)
        pieces = self.chunks(normal)
        ids = pc.list_flatten(pc.split_pattern(pieces.names.take(pa.array(pieces.where)), ",")).cast(pa.int32())
        return ids, *self.spans(normal, pieces)

    def decode(self, ids: list[int]) -> str:
        return self._decoded(b"".join([self.bytes_of[i] for i in ids]))


@lru_cache(2)
def codec(path: str) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read())


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, begins, ends of every text: each piece's id and its byte span in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for b in slices(batches, most=STEP):
            ids, begins, ends, first = own.encode(texts(column_of(b, "text")))
            lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, t)) for x, t in ((ids, pa.int32()), (begins, pa.int64()), (ends, pa.int64()))]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), *lists], ["doc_id", "ids", "begins", "ends"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, begins array<long>, ends array<long>")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and spans_sha256 of every text, encoded and decoded again.

    spans_sha256 is that of the begin and end of each piece, in order, as little-endian 64-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for b in slices(batches, most=STEP):
            normal = own.normalise(texts(column_of(b, "text")))
            pieces = own.chunks(normal)
            begins, ends, first = own.spans(normal, pieces)
            both, cut = np.stack([begins, ends], 1).astype("<i8"), first.tolist()
            ids = [sha(x.encode()) for x in own._joined(pieces.names, pieces, ",")]
            decoded = [sha(own._decoded(x).encode()) for x in own._joined(pieces.decoded, pieces, b"")]
            spans = [sha(both[i:j]) for i, j in zip(cut, cut[1:], strict=False)]
            columns = [pa.array(np.diff(first), pa.int64()), *(pa.array(x, pa.string()) for x in (ids, decoded, spans))]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
