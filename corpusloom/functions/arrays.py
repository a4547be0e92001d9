"""Vectorised text kernels over Arrow string batches: code points, classes, runs, hashes of slices.

A batch is laid out as one array of code points; words and shingles are slices of it. A slice's
64-bit hash comes from a prefix sum of a polynomial, so no Python object is made for each word.
Batches are cut into blocks of at most ``BLOCK`` bytes of text (or one text, if longer) to bound
a worker's memory.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
OTHER, LETTER, NUMBER, SPACE, MARK = range(5)
# Unicode White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def classes() -> np.ndarray:
    """Class of each code point: OTHER, LETTER, NUMBER, SPACE or MARK."""
    first = {"L": LETTER, "N": NUMBER, "M": MARK}
    out = np.fromiter((first.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = SPACE
    return out


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, b, np.uint64)))) for b in (_BASE, _INVERSE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, for n positions at least."""
    return _powers(max(1 << 16, 1 << (n - 1).bit_length() if n > 1 else 1))


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the n + 1 offsets of the texts in them; null counts as empty."""
    if len(texts) == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = memoryview(data)[offs[0] : offs[-1]] if data is not None else b""
    offs = offs - offs[0]
    octets = np.frombuffer(raw, np.uint8)
    if not (octets & 0x80).any():
        return octets.astype(np.uint32), offs
    try:
        cp = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        fixed = [str(raw[a:b], "utf-8", "replace") for a, b in zip(offs, offs[1:])]
        return code_points(pa.array(fixed, pa.large_string()))
    count = np.zeros(len(octets) + 1, np.int64)
    np.cumsum((octets & 0xC0) != 0x80, out=count[1:])
    return cp, count[offs]


def slices(texts: pa.Array, size: int = BLOCK) -> Iterator[pa.Array]:
    """Consecutive parts of a batch of at most ``size`` bytes, or of one text."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    ends = np.cumsum(np.array(pc.binary_length(texts).fill_null(0), dtype=np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield texts.slice(at, to - at)
        at = to


def blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``code_points`` of consecutive slices of the batch."""
    for part in slices(texts):
        yield code_points(part)


def segment_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices ``values[start:end]``; equal slices have equal hashes wherever they lie."""
    up, down = powers(len(values) + 1)
    mixed = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed * up[: len(values)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(32)
    return h * _BASE + (ends - starts).astype(np.uint64)


def runs(flags: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true flags; a run never crosses a text's end."""
    n = len(flags)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = flags.copy(), flags.copy()
    begin[1:] &= ~flags[:-1]
    end[:-1] &= ~flags[1:]
    inner = offs[(offs > 0) & (offs < n)]
    begin[inner] |= flags[inner]
    end[inner - 1] |= flags[inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1
