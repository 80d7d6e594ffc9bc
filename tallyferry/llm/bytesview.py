"""Vectorised work on the UTF-8 bytes of Arrow string columns.

Operators that run Python read whole texts as Arrow batches and look at many
documents at once through numpy, instead of word by word. A batch is cut into
slices of bounded bytes at document borders, so memory follows the slice (or
the one document that is longer), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


class Slice(NamedTuple):
    """Documents first..last of a batch: their bytes, and where each begins and ends."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The column's texts in slices of about ``limit`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        own = offsets[at : to + 1] - offsets[at]
        yield Slice(at, data[offsets[at] : offsets[to]], own[:-1], own[1:])
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all of them."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_A
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_B
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to exponent ``n``."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


class Words(NamedTuple):
    """Words of a slice: byte positions, the document each belongs to, its hash.

    ``stems``: for each length asked for, which words are longer and the hashes of
    their first bytes.
    """

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    stems: list[tuple[np.ndarray, np.ndarray]]


def words(part: Slice, lower: bool = False, letters: bool = False, stems: tuple[int, ...] = ()) -> Words:
    """Runs of bytes other than ``[\\x20\\x09-\\x0D]``, never across documents.

    With ``letters``, runs of ASCII letters and digits and of bytes beyond ASCII.
    """
    data = LOWER[part.data] if lower else part.data
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~(_NOT_ALNUM if letters else _SPACE)[data]
    border = np.zeros(n + 1, bool)
    border[part.starts] = True
    border[part.ends] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    doc = np.searchsorted(part.ends, begin, side="right")
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:n], out=sums[1:])
    scale = down[begin]
    hashes = mix((sums[end] - sums[begin]) * scale + (end - begin).astype(np.uint64))
    parts = []
    for size in stems:
        longer = np.flatnonzero(end - begin > size)
        at = begin[longer]
        parts.append((longer, mix((sums[at + size] - sums[at]) * scale[longer] - np.uint64(size))))
    return Words(begin, end, doc, hashes, parts)


def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbours; empty when there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out = mix(out * _BASE + hashes[k : k + n])
    return out


def same_doc(doc: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` neighbouring words lie in one document."""
    n = len(doc) - size + 1
    if n <= 0:
        return np.empty(0, bool)
    return doc[:n] == doc[size - 1 : size - 1 + n]
