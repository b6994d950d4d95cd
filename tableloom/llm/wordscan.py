"""Words of many texts at once: vectorised scans over Arrow's string buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.  Nothing here copies
texts into Python strings; memory is bounded by CHUNK bytes of text at a time, or by one text if it is longer.
"""

from __future__ import annotations

import ctypes
import time
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

CHUNK = 1 << 20
RUN = 1 << 19  # bytes hashed at a time
U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWERED = _BYTE[LOWER]
_P = U(0x9E3779B97F4A7C15)
_PINV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_trimmed = 0.0
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_powers: dict[str, np.ndarray] = {}


@lru_cache(maxsize=1)
def _libc() -> ctypes.CDLL | None:
    try:
        lib = ctypes.CDLL(None)
        lib.malloc_trim  # noqa: B018  glibc has it
        return lib
    except (OSError, AttributeError):
        return None


def trim() -> None:
    """Gives memory that is no longer used back to the system, a few times a second at most, so that a worker keeps little."""
    global _trimmed
    if time.monotonic() - _trimmed < 0.3:
        return
    pa.default_memory_pool().release_unused()
    if _libc():
        _libc().malloc_trim(0)
    _trimmed = time.monotonic()


def small_batches(spark: SparkSession) -> None:
    """Where the session has Spark's default of 10,000 rows to an Arrow batch, sets it to 1,000: rows are whole texts here.

    Both the executor's JVM and its Python workers hold whole batches, outside the heap.
    """
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        spark.conf.set(BATCH_ROWS, "1000")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = np.asarray(x, U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of both bases up to n - 1; those up to RUN are kept."""
    if "up" not in _powers:
        for name, p in (("up", _P), ("down", _PINV)):
            x = np.full(RUN + 1, p, U)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about limit bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def solid(data: np.ndarray) -> np.ndarray:
    """Which bytes are no white space."""
    return (data != 0x20) & (data - np.uint8(9) > 4)  # below 9 the difference wraps


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end; a text's bounds also bound its words."""
    inside = solid(data)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = at[1:] > at[:-1]
    first, last = at[:-1][full], at[1:][full] - 1
    start[first], end[last] = inside[first], inside[last]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, lower-cased: a polynomial over random byte values, then mixed.  Spans are in order.

    At most RUN bytes are looked at together, or one span if it is longer: that one is hashed in runs.
    """
    out = np.empty(len(start), U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + RUN, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        if hi - lo <= RUN:
            up, down = _power(hi - lo + 1)
            total = np.zeros(hi - lo + 1, U)
            value = _LOWERED[data[lo:hi]]
            value *= up[:-1]
            np.cumsum(value, out=total[1:])
            out[i:j] = (total[end[i:j] - lo] - total[start[i:j] - lo]) * down[start[i:j] - lo]
        else:
            up, value, shift = _power(RUN)[0], 0, 1
            for k in range(lo, hi, RUN):
                part = data[k : min(hi, k + RUN)]
                value += int((_LOWERED[part] * up[: len(part)]).sum(dtype=U)) * shift
                shift = shift * pow(int(_P), RUN, 2**64) % 2**64
            out[i] = U(value % 2**64)
        i = j
    return mix(out ^ ((end - start).astype(U) * U(0xD6E8FEB86659FD93)))


def shingles(word: np.ndarray, first: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each text (its words are word[first[i]:first[i + 1]]) the sorted distinct hashes of its n-word shingles.

    A text of fewer words has one shingle, the whole sequence; a text without words has none.
    """
    if len(word) >= n:
        run = np.zeros(len(word) - n + 1, U)
        for k in range(n):
            run = run * U(0x2545F4914F6CDD1D) + word[k : len(word) - n + 1 + k]
        run = mix(run)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= n:
            one = np.sort(run[lo : hi - n + 1])
            yield one[np.r_[True, one[1:] != one[:-1]]] if len(one) > 1 else one
        elif hi > lo:
            short = U(hi - lo)
            with np.errstate(over="ignore"):
                for x in word[lo:hi]:
                    short = short * U(0x9FB21C651E98DF25) + x
            yield mix(np.array([short], U))
        else:
            yield np.zeros(0, U)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x, U).view(np.int64)


def lists(parts: list[np.ndarray], kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list<long> column of arrays of unsigned or signed 64-bit values."""
    sizes = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, U)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat.view(np.int64), kind or pa.int64()))
