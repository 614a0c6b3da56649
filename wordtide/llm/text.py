"""Whole columns of text as flat byte arrays: words, hashes, and sums per text, without row loops.

Arrow keeps the texts of a batch in one buffer with offsets. The functions here work on that buffer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once. A block holds at least one whole text.
BLOCK_BYTES = 1 << 20
# Bytes of neighbouring spans that are hashed at once, in arrays that stay in a processor's cache.
HASHED_BYTES = 1 << 15
# Bytes of a span whose second hash is added up place by place.
SHORT = 32
# Spans whose second hashes are made at once.
HASHED_SPANS = 1 << 14

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
U64 = np.uint64
_P1, _P2 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_RANDOM = mix(np.arange(1, 257, dtype=np.uint64) * _P2)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if large else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) for runs of whole texts of about ``size`` bytes.

    Once through, what Arrow keeps of earlier batches goes back to the system: workers live on, and
    would hold the memory of the largest batch of every operator that they have served.
    """
    data, offsets = flat(column)
    low, n = 0, len(column)
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high
    release()


def release() -> None:
    """Give freed Arrow memory back."""
    pa.default_memory_pool().release_unused()


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, runs before each text) of the runs of set places; text ends part runs."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    fresh = np.zeros(n + 1, bool)
    fresh[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | fresh[1:n]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | fresh[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of the words, which white space and text ends bound."""
    return spans(~_SPACE[data], offsets)


@cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd ``base`` modulo 2^64, and those of its inverse, for the places of a piece."""
    return tuple(_power_row(U64(x), HASHED_BYTES) for x in (base, pow(base, -1, 1 << 64)))


def _power_row(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = _P1) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans must be in order, not empty, and not overlap.

    It is a polynomial in ``base``, taken as a difference of running sums, less the power of the span's place.
    """
    n, low = len(starts), 0
    out = np.zeros(n, U64)
    powers, inverses = _powers(int(base))
    while low < n:
        first = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, first + HASHED_BYTES, "right")))
        size = int(ends[high - 1] - first)
        values = np.zeros(size + 1, U64)
        values[1:] = data[first : first + size]
        values[1:] += U64(1)
        values[1:] *= powers[:size] if size <= len(powers) else _power_row(base, size)
        np.cumsum(values, out=values)
        some = starts[low:high] - first
        out[low:high] = (values[ends[low:high] - first] - values[some]) * inverses[some]
        low = high
    return mix(out + (ends - starts).astype(U64) * _P2)


def second_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second hash of the spans, of another structure; the two together are 128 bits.

    It adds up a random number for each byte, scrambled by one for its place, so it is no polynomial
    of the bytes: words that clash in the first hash for its algebra do not in this one.
    """
    if len(starts) == 0:
        return np.zeros(0, U64)
    lengths = ends - starts
    places = mix(np.arange(int(lengths.max()), dtype=U64) * _P1 + _P2)
    total = np.empty(len(starts), U64)
    for low in range(0, len(starts), HASHED_SPANS):
        piece = slice(low, low + HASHED_SPANS)
        # place by place, over the spans that reach it, which are the last ones by length
        capped = np.minimum(lengths[piece], SHORT).astype(np.uint8)
        sort = np.argsort(capped, kind="stable")
        at, part = starts[piece][sort], np.zeros(len(sort), U64)
        shorter = np.cumsum(np.bincount(capped)).tolist()
        for place, first in enumerate(shorter[:-1]):
            some = at[first:]
            values = _RANDOM.take(data.take(some))
            values ^= places[place]
            part[first:] += values
            some += 1
        total[low + sort] = part
    long = np.flatnonzero(lengths > SHORT)
    if len(long):
        rest = lengths[long] - SHORT
        before = np.concatenate(([0], np.cumsum(rest)[:-1]))
        at = np.arange(int(rest.sum())) - np.repeat(before, rest) + SHORT
        total[long] += np.add.reduceat(_RANDOM[data[at + np.repeat(starts[long], rest)]] ^ places[at], before)
    return mix(total * _P1 + lengths.astype(U64))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]], 0 for an empty range."""
    total = np.concatenate(([0], np.cumsum(values, dtype=values.dtype if values.dtype.kind == "f" else np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def exact_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Float sums per range without the rounding of differences of running sums."""
    out = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values.astype(np.float64), bounds[:-1][full])
    return out


def gram_hashes(units: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every run of ``q`` units; ``len(units) - q + 1`` of them."""
    n = len(units) - q + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    wide = units.astype(U64) + U64(1)
    for i in range(q):
        out *= _P1
        out += wide[i : i + n]
    return out


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return values.view(np.int64)
