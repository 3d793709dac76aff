"""Words of Arrow text columns as numpy arrays: byte ranges and 64-bit hashes.

Texts are handled as UTF-8 bytes with A-Z lower-cased. A word is a maximal run of
bytes of a class; a row boundary always ends a word. Hashes are polynomials over a
fixed random byte table, so all words of a chunk are hashed by array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # text handled at once; a longer single text is a chunk of its own

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Truth table of the bytes within any of the inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: 0-9, a-z (after lower-casing) and everything beyond ASCII
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: everything but space and \t \n \v \f \r
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    forward = np.full(n, _BASE, dtype=np.uint64)
    forward[0] = 1
    back = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    return np.multiply.accumulate(forward), np.multiply.accumulate(back)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    return _powers(max(CHUNK_BYTES + 1, 1 << (n - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    forward, back = powers(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * forward[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * back[: n - width + 1] + np.uint64(width * _BASE & _MASK))


@dataclass
class Words:
    """Words of some consecutive rows. ``first[r]:first[r + 1]`` are the words of row ``r``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    def text(self, word: int, count: int = 1) -> bytes:
        """``count`` words from ``word`` on, joined by one space."""
        return b" ".join(
            self.data[s:e].tobytes() for s, e in zip(self.starts[word : word + count], self.ends[word : word + count])
        )


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets in them; null rows are empty."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    width = np.dtype(np.int64 if large else np.int32)
    offsets = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or one row."""
    _, offsets = text_buffers(column)
    row, rows = 0, len(column)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, end
        row = end


def segments(column: pa.Array, kind: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, pa.Array, bool]]:
    """(first row, texts, whole): rows of about ``limit`` bytes together; a longer row in parts.

    Parts of a row are cut before a byte outside the class ``kind``, so no word is cut;
    all but the first have ``whole`` False. The limit is ``CHUNK_BYTES`` if not given.
    """
    limit = limit or CHUNK_BYTES
    for low, high in chunks(column, limit):
        some = column.slice(low, high - low)
        data, offsets = text_buffers(some)
        if high - low > 1 or offsets[1] - offsets[0] <= limit:
            yield low, some, True
            continue
        begin, end, whole = int(offsets[0]), int(offsets[1]), True
        while begin < end:
            seen, cut = begin + 1, min(end, begin + limit)
            while cut < end:
                gaps = np.flatnonzero(~kind[data[seen:cut]])
                if len(gaps):
                    cut = seen + int(gaps[-1])
                    break
                seen, cut = cut, min(end, cut + limit)
            yield low, pa.array([data[begin:cut].tobytes()], pa.binary()), whole
            begin, whole = cut, False


def words_of(column: pa.Array, kind: np.ndarray) -> Words:
    """Words of all rows of a column whose bytes belong to the class ``kind``."""
    data, offsets = text_buffers(column)
    data = _LOWER[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    n = len(data)
    inside = kind[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(end) + 1
    forward, back = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * forward[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, np.searchsorted(starts, offsets), offsets, hashes)
