"""Numpy building blocks used inside Arrow tasks: texts as one byte buffer,
words and their hashes, hashes of all windows, minima of sliding ranges, and
unions of ranges.  Everything works on one bounded slice of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are processed at a time (a longer single text is its own slice).
SLICE_BYTES = 1 << 18

_U = np.uint64
# Multipliers of the finalizer and bases of the polynomial hashes: fixed odd values.
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
KEPT_POWERS = SLICE_BYTES + 2


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = np.asarray(x, _U)
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


_BYTE_VALUES = [mix(np.arange(256, dtype=_U) + _U(1 + 1000 * k)) for k in range(2)]


def powers(n: int, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base, and of its inverse, modulo 2**64.  Those
    of a slice are kept; longer texts get their own, for as long as they last."""
    if n > KEPT_POWERS:
        return _made_powers(n, kind)
    if kind not in _powers:
        _powers[kind] = _made_powers(KEPT_POWERS, kind)
    both, inverse = _powers[kind]
    return both[:n], inverse[:n]


def _made_powers(n: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASES[kind], pow(_BASES[kind], -1, 1 << 64)):
        p = np.full(n, base, _U)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def prefix_sums(values: np.ndarray, kind: int = 0) -> np.ndarray:
    """Running sums of value * base**position, with a leading zero."""
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(len(values), kind)[0], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    """Hash of values[start:end) for each pair, whatever the position."""
    inverse = powers(len(sums), kind)[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))


def byte_sums(data: np.ndarray, kind: int = 0) -> np.ndarray:
    return prefix_sums(_BYTE_VALUES[kind][data], kind)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of the words ``[^\\x20\\x09-\\x0D]+``
    and the word offsets of each row.  ``offsets`` begin at 0."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    return span_hashes(byte_sums(data, kind), starts, ends, kind)


def range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo:hi]) for ranges that are not empty."""
    width = hi - lo
    out = np.empty(len(lo), values.dtype)
    level, size, table = 0, 1, values
    top = int(width.max()) if len(width) else 0
    while size <= top:
        use = (width >= size) & (width < 2 * size)
        a, b = lo[use], hi[use] - size
        out[use] = np.minimum(table[a], table[b])
        if len(table) > size:
            table = np.minimum(table[:-size], table[size:])
        level, size = level + 1, 2 * size
    return out


def concat_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i]+1, ... (counts[i] values) for each i, in a row."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return at + np.arange(total)


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of the positions below ``length`` inside any range."""
    step = np.zeros(length + 1, np.int64)
    np.add.at(step, np.minimum(starts, length), 1)
    np.add.at(step, np.minimum(ends, length), -1)
    return np.cumsum(step[:-1]) > 0
