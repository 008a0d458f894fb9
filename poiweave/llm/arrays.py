"""Vectorised tokens and hashes over Arrow string columns, for the operators that run Python on batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from poiweave.session import ship_package

_ODD = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed & 0xFFFFFFFF) * np.uint64(0x10001)) * np.uint64(_ODD))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = constants(256, 17)
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_powers = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column as one array, and where each row starts in it. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=8 * column.offset)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes; a longer row is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` and the first word of each row (one more entry closes)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    ink = ~_SPACE[raw]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]
    first[edge] |= ink[edge]
    last[edge - 1] |= ink[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each range of bytes, A-Z lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_LOWERED if lower else _VALUES)[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A-Z lower-cased, and the first word of each row (one more entry closes)."""
    starts, ends, rows = word_bounds(raw, offsets)
    return hashes_of(raw, starts, ends, lower), rows


_MARK, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def without_marks(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, with marks behind a letter or figure (ASCII or of U+00C0 to U+00FF) as words of their own, and the new place of each word."""
    cut = ends.copy()
    todo = np.arange(len(cut))
    while len(todo := todo[_MARK[raw[cut[todo] - 1]] & (cut[todo] - 1 > starts[todo])]):
        cut[todo] -= 1
    last, before = raw[cut - 1], raw[np.maximum(cut - 2, 0)]
    letter = _ALNUM[last] | ((before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7))
    split = (cut < ends) & letter
    number = 1 + split
    first = np.cumsum(number) - number
    starts, ends = np.repeat(starts, number), np.repeat(ends, number)
    ends[first[split]] = starts[first[split] + 1] = cut[split]
    return starts, ends, first


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One place of each distinct value, in order of values; for every value its number among them; and how often each occurs."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[at], number, np.diff(np.append(at, len(values)))


def ranges(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of an array end to end, and where each one begins (one more entry closes)."""
    done = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(starts - done[:-1], sizes) + np.arange(done[-1])], done


def gather(parts: list[bytes], kind: np.dtype, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of parts (bytes of ``kind``) end to end, in the order ``place``, and where each one begins (one more entry closes)."""
    flat = np.frombuffer(b"".join(parts), kind)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(kind).itemsize
    return ranges(flat, (np.cumsum(size) - size)[place], size[place])


def slices(batch: pa.RecordBatch, column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes in a string column; a longer row is a part of its own."""
    offsets = strings(batch.column(column))[1]
    for i, j in chunks(offsets, size):
        yield batch.slice(i, j - i)


def trim() -> None:
    """Give a worker's freed memory back to the system: workers are used again, and the C library keeps what it once had."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


#: Rows and bytes of an Arrow batch, at most.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def at_most(spark, key: str, most: int) -> None:
    """Lower a numeric setting of the session, unless it is as low already."""
    now = str(spark.conf.get(key)).rstrip("bB")
    if not now.isdigit() or not 0 < int(now) <= most:
        spark.conf.set(key, str(most))


def prepare(spark) -> None:
    """Ready a session for Python workers: this package on every executor, and bounded Arrow batches.

    Spark reads the bounds when a plan runs, so they stay lowered in the session; lower ones are left alone.
    """
    at_most(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    at_most(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship_package(spark)
