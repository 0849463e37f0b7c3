"""Vectorised word scanning of Arrow text columns inside Spark tasks.

Texts are handled as UTF-8 bytes: every word class used here is decided by single bytes, because all bytes of a
non-ASCII character are 0x80 or more. A batch is cut into chunks of whole texts, so memory stays near a constant
multiple of ``CHUNK_BYTES`` (or of the longest text, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

_BYTES = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes other than space and 0x09-0x0D.
NOT_BLANK = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Bytes of the class [^\x00-\x2F\x3A-\x60\x7B-\x7F].
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            _powers = tuple(
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (_BASE, _BASE_INVERSE)
            )
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def chunks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, bytes, offsets)`` for runs of whole texts; null counts as empty.

    ``offsets`` has one entry more than texts in the chunk and starts at 0.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, off_buffer, data_buffer = column.buffers()
    off = np.frombuffer(off_buffer, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + CHUNK_BYTES, "right")) - 1)
        yield first, data[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of bytes with ``inside``; none crosses a text's bounds."""
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    m = inside[data]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    begin, end = off[:-1][off[:-1] < off[1:]], off[1:][off[:-1] < off[1:]] - 1
    first[begin], last[end] = m[begin], m[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges."""
    power, inverse = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts])


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words, one for each first word that has enough followers in the array."""
    n = max(len(hashes) - size + 1, 0)
    out = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix(out * _BASE + hashes[k : n + k])
    return out


def first_of_runs(owner: np.ndarray, n: int) -> np.ndarray:
    """For sorted owner numbers: where each of the owners 0..n-1 begins, and the total at the end."""
    return np.searchsorted(owner, np.arange(n + 1), "left")
