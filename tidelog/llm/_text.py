"""Shared kernels over Arrow text columns.

Everything here works on bounded slices of a record batch, so memory follows the slice (or the longest single text),
never the partition. A null text counts as an empty text.
"""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one slice of a batch holds, unless a single text is longer.
SLICE_BYTES = 1 << 20

U64 = np.uint64
_P = U64(0x9E3779B97F4A7C55)
_P_INV = U64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def texts(column: pa.Array) -> pa.Array:
    """The column as large_string without nulls."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets (from 0) of a column made by texts()."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])), at - at[0]


def release() -> None:
    """Gives memory that is free back to the machine: a worker waits for its next task with what it needs."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about `most` bytes of text at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = raw(texts(batch.column(batch.schema.get_field_index(column))))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            j = min(j, i + 50_000)
            yield batch.slice(i, j - i)
            i = j
    release()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _power(n: int) -> list[np.ndarray]:
    """P^0..P^n-1 and their inverses modulo 2^64."""
    if len(_powers[0]) < n:
        n = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_P, _P_INV)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal inputs give equal outputs, any bit moves all bits."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: The value of each byte in span_hashes.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] for many spans at once: differences of one running polynomial.

    values: uint64, one well-mixed number for each symbol. Equal spans have equal hashes wherever they stand. Long spans can
    be made to collide, so these only deal spans to buckets; where equality counts, use distinct() or named().
    """
    n = len(values)
    power, inverse = _power(n + 1)
    run = np.zeros(n + 1, U64)
    np.cumsum(values * power[:n], out=run[1:])
    h = (run[ends] - run[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0x2545F4914F6CDD1D))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes, so all other characters, stay."""
    return _LOWER[data]


def table_of(*ranges: tuple[int, int]) -> np.ndarray:
    """A boolean table of 256 bytes, true in the inclusive ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document of each maximal run of `inside`, where runs never cross the offsets `at`."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = at[(at > 0) & (at < n)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct strings among data[offsets[i]:offsets[i + 1]], compared byte by byte, and the place of each in them."""
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = column.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def named(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit names of the bytes data[start:end] for many spans at once.

    Up to 16 bytes are taken as two numbers and mixed with the length, so up to 8 bytes equal names mean equal bytes of
    that length; longer spans are digested by BLAKE2b. No structure of the bytes makes two names meet.
    """
    size = ends - starts
    padded = np.zeros(len(data) + 24, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 16, "<u8", padded.data, strides=(1,))  # the 8 bytes from each byte on
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
    out = mix(eight[starts] & mask[np.minimum(size, 8)]) + size.astype(U64) * U64(0x2545F4914F6CDD1D)
    more = np.flatnonzero(size > 8)
    out[more] = mix(out[more]) * U64(0x9FB21C651E98DF25) + mix(eight[starts[more] + 8] & mask[np.minimum(size[more] - 8, 8)])
    out = mix(out)
    for k in np.flatnonzero(size > 16).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return out


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """One 64-bit name for each row of equally long columns of names; order counts, and every step is mixed."""
    out = np.zeros(len(parts[0]), U64)
    for p in parts:
        out = mix(out * U64(0x9FB21C651E98DF25) + p)
    return out
