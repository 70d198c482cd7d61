"""Texts of an Arrow column as bytes, words and hashes in numpy.

Columns are cut into slices of bounded size, so what a task holds does not follow the
number of rows of a batch; one very long text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
# An odd factor of the polynomial hash and of the mixing steps, modulo 2**64.
_FACTOR = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; NULL is empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = filled.buffers()
    ends = np.frombuffer(where, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    all_bytes = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(filled):
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(filled))
        yield first, all_bytes[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def strings(column: pa.Array) -> list[bytes]:
    """The texts as bytes; NULL is empty."""
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; bytes of other characters stay."""
    return _LOWER[data]


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true, cut at the texts' ends; words before each text."""
    before = np.zeros(len(is_word) + 1, bool)
    before[1:] = is_word
    before[offsets[:-1]] = False
    starts = np.flatnonzero(is_word & ~before[:-1])
    after = np.zeros(len(is_word) + 1, bool)
    after[:-1] = is_word
    after[offsets[1:]] = False
    ends = np.flatnonzero(is_word & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_FACTOR, -1, 1 << 64)
    up, down = np.full(length, _FACTOR, np.uint64), np.full(length, inverse, np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of each word: a polynomial of its bytes, from running sums, then mixed."""
    length = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(length)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def mixed(value: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    value = (value ^ (value >> np.uint64(32))) * np.uint64(_FACTOR)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))
