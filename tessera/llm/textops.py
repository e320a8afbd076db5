"""Word and shingle hashes of Arrow text columns with numpy.

Texts stay UTF-8 bytes.  A word is a maximal run of bytes other than space and
``\\x09-\\x0D``.  Hashes are 64 bits: a word's bytes are taken eight at a time,
each scrambled with what came before, and a window's is a polynomial over the
scrambled hashes of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_P, _Q = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_LANES = 8  # a word of more than so many eight bytes is hashed on its own
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)  # keeps the first k of eight bytes
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> list[np.uint64]:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    return [U64(pow(base, k, 1 << 64)) for k in range(n)]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (a longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row its first word (one more entry closes the last row).

    ``separator`` tells for each byte whether it lies between words.
    """
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = separator[data]
    edge = np.empty(len(data) + 1, bool)  # a word cannot cross this position
    edge[0] = edge[-1] = True
    edge[1:-1] = space[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(~space & edge[:-1])
    edge[1:-1] = space[1:]
    edge[offsets] = True
    ends = np.flatnonzero(~space & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` folds A-Z first.

    Words of up to eight bytes and the same length never share a hash.
    """
    if lower:
        data = _LOWER[data]
    room = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", room, strides=(1,))  # the eight bytes from each place on
    size = ends - starts
    out = mix(size.astype(U64) * U64(_P) + U64(seed))
    at = np.flatnonzero(size <= 8 * _LANES)
    for k in range(_LANES):
        at = at[size[at] > 8 * k]
        if not len(at):
            break
        lane = eight[starts[at] + 8 * k] & _TAIL[np.minimum(size[at] - 8 * k, 8)]
        out[at] = mix(out[at] ^ lane) * U64(_P)
    for i in np.flatnonzero(size > 8 * _LANES).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out


def windows(hashes: np.ndarray, first: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows and the row of each, rows in order.

    ``short``: a row of fewer words (but at least one) gives its whole sequence
    as one window.
    """
    count = np.diff(first)
    full = np.maximum(count - size + 1, 0)
    rows = np.repeat(np.arange(len(count)), full)
    begin = np.cumsum(full) - full
    at = np.arange(len(rows)) - begin[rows] + first[:-1][rows]
    sums = np.zeros(len(rows), U64)
    for k, q in enumerate(_powers(_Q, size)):
        sums += hashes[at + k] * q
    sums = mix(sums + U64(size))
    if short:
        few = np.flatnonzero((count > 0) & (count < size))
        less = np.zeros(len(few), U64)
        for k, q in enumerate(_powers(_Q, size - 1)):
            has = count[few] > k
            less[has] += hashes[first[:-1][few[has]] + k] * q
        sums = np.concatenate([sums, mix(less + count[few].astype(U64))])
        rows = np.concatenate([rows, few])
        order = np.argsort(rows, kind="stable")
        sums, rows = sums[order], rows[order]
    return sums, rows


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, sorted hashes, bounds)`` for slices of the rows.

    Row ``first + i`` has the distinct shingles ``hashes[bounds[i]:bounds[i + 1]]``.
    """
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words(part, off)
        sums, rows = windows(word_hashes(part, starts, ends, lower=True), first, size, short=True)
        order = np.lexsort((sums, rows))
        sums, rows = sums[order], rows[order]
        fresh = np.ones(len(sums), bool)
        fresh[1:] = (sums[1:] != sums[:-1]) | (rows[1:] != rows[:-1])
        sums, rows = sums[fresh], rows[fresh]
        yield i, sums, np.searchsorted(rows, np.arange(j - i + 1))


def hash_of(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit value for each set (order-free)."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(sets + U64(0x51)), dtype=U64)])
    other = np.concatenate([np.zeros(1, U64), np.cumsum(mix(sets ^ U64(0xA5A5A5A5A5A5A5A5)), dtype=U64)])
    size = np.diff(bounds).astype(U64)
    a, b = total[bounds[1:]] - total[bounds[:-1]], other[bounds[1:]] - other[bounds[:-1]]
    return mix(a ^ mix(b + size))
