"""Vectorised text primitives shared by the operators.

Texts arrive as Arrow string arrays; their UTF-8 buffers are viewed as numpy
bytes without making a Python string per row.  Work is done in blocks of about
``BLOCK_BYTES``; a longer text is one block of its own, so memory follows the
longest text (about 40 bytes for each of its bytes) and never a whole partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: Bytes or letters that are hashed at once.
SLICE = 1 << 18
#: Odd, so that it has an inverse modulo 2**64.
RADIX = 0x9E3779B97F4A7C15
RADIX_INVERSE = pow(RADIX, -1, 1 << 64)
U64 = np.uint64

_BYTE_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_CODES = _BYTE_CODES.copy()
_LOWER_CODES[65:91] = _BYTE_CODES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown by doubling and kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.cumprod(have, out=have)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets and len(column) else np.zeros(len(column) + 1, np.int64)
    body = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return at - at[0], body[at[0] : at[-1]]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def segment_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """64-bit polynomial hashes of values[start:end], mixed; equal segments are equal anywhere.

    With ``table`` the values are its indices.  Starts and ends ascend.  Work is
    done in slices, so memory does not follow the values but the longest segment.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(starts):
            base = int(starts[first])
            last = max(first + 1, int(np.searchsorted(ends, base + SLICE, "right")))
            part = values[base : int(ends[last - 1])]
            codes = part if table is None else table[part]
            total = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(codes * powers(RADIX, len(codes)), out=total[1:])
            s, e = starts[first:last] - base, ends[first:last] - base
            out[first:last] = (total[e] - total[s]) * powers(RADIX_INVERSE, len(codes) + 1)[s]
            first = last
        return mix(out)


def words(body: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, byte start) of every run of bytes other than ASCII white space.

    Offsets are relative to body.  With ``lower``, A-Z count as a-z.
    """
    space = np.ones(len(body) + 2, bool)
    space[1:-1] = _SPACE[body]
    first = ~space[1:-1] & space[:-2]
    last = ~space[1:-1] & space[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(body))]
    first[cuts] |= ~space[1:-1][cuts]
    last[cuts - 1] |= ~space[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = segment_hashes(body, starts, ends, _LOWER_CODES if lower else _BYTE_CODES)
    return hashes, np.searchsorted(offsets, starts, "right") - 1, starts


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``width`` words; a shorter row counts as one run."""
    count = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    with np.errstate(over="ignore"):
        combined = np.zeros(len(hashes), np.uint64)
        left = count[rows] - (np.arange(len(hashes)) - first[rows]) if len(hashes) else np.zeros(0, np.int64)
        for k, p in enumerate(powers(0xD6E8FEB86659FD93, width)):
            shifted = np.zeros(len(hashes), np.uint64)
            if k < len(hashes):
                shifted[: len(hashes) - k] = hashes[k:]
            combined += np.where(left > k, (shifted + U64(k + 1)) * p, U64(0))
        keep = (left >= width) | (left == count[rows])
        # The length tells a short row's only run from a full one.
        size = np.minimum(left, width).astype(np.uint64)
        return mix(combined + size * U64(0xA24BAED4963EE407))[keep], rows[keep]
