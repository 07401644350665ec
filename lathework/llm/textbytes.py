"""Numpy on the raw bytes of Arrow text columns: rolling hashes, words, shingles.

A hash of any stretch of bytes comes from two prefix sums over powers of an odd number modulo
2^64, mixed at the end. All loops over bytes and words run inside numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1
OTHER = 0xC2B2AE3D27D4EB4F | 1
MASK = (1 << 64) - 1

_powers: dict = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2^64 for i below ``n`` at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:  # doubling: a stretch times the power at its end
                more = min(done, size - done)
                p[done:done + more] = p[:more] * np.uint64(pow(b, done, 1 << 64))
                done += more
            out.append(p)
        if size <= 4 * CHUNK_BYTES:  # a longer table is for one long text only
            _powers[base] = tuple(out)
        have = tuple(out)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray, base=BASE) -> np.ndarray:
    """``s`` with ``(s[b] - s[a]) * base**-a`` the hash of ``data[a:b]``."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data))[0][:len(data)], out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray, base=BASE) -> np.ndarray:
    """Mixed hashes of the stretches from ``a`` to ``b``."""
    return mixed((sums[b] - sums[a]) * powers(base, len(sums))[1][a])


def chunks(column, most=CHUNK_BYTES):
    """``(first row, offsets, bytes)`` of runs of rows of a text column; null is empty.

    A run has about ``most`` bytes, or one row if that is longer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row, n = 0, len(column)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        end = min(end, n)
        yield row, offsets[row:end + 1] - offsets[row], data[offsets[row]:offsets[end]]
        row = end


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(offsets: np.ndarray, data: np.ndarray, space=_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each row; ``space``: which bytes part words."""
    n = len(data)
    word = ~space[data]
    edge = np.zeros(n + 1, dtype=bool)  # a row's end ends a word
    edge[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_array(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Words that follow each other in ``data`` without gaps."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def shingles(offsets: np.ndarray, data: np.ndarray, words=5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a run of rows, and the number of the first one of each row.

    A-Z count as a-z. A row with fewer words has its whole sequence as one shingle; a row
    without words has none.
    """
    data = _LOWER[data]
    starts, ends, first = word_bounds(offsets, data)
    count = np.diff(first)
    own = np.where(count == 0, 0, np.maximum(count - words + 1, 1))
    begin = np.concatenate([[0], np.cumsum(own)])
    hashes = stretch_hash(prefix_sums(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    # word number of each shingle's first word, and how many words it has
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], own)
    size = np.repeat(np.minimum(count, words), own)
    total = np.full(len(at), 0, dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    factor = OTHER
    for j in range(words):
        factor = factor * BASE & MASK
        total += np.where(j < size, padded[at + j] * np.uint64(factor), np.uint64(0))
    return mixed(total + size.astype(np.uint64)), begin


def distinct_by_row(hashes: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct numbers of each row."""
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        x = np.sort(hashes[a:b])
        out.append(x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) > 1 else x)
    return out
