"""Small numpy helpers over Arrow text columns: slices of bounded size, word spans, hashes.

All of them work on the UTF-8 bytes. Both word rules of this package are byte rules, because every
byte of a multi-byte character is above 0x7F.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of every bit over all bits."""
    h = (h ^ (h >> np.uint64(32))) * ODD
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_bytes(alphanumeric: bool) -> np.ndarray:
    """Which bytes belong to words: all but white space, or only 0-9, a-z and bytes above 0x7F."""
    table = np.ones(256, bool)
    if alphanumeric:
        table[:128] = False
        table[ord("0") : ord("9") + 1] = table[ord("a") : ord("z") + 1] = True
    else:
        table[list(SPACES)] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Texts:
    """Some documents' bytes in one array: `data`, and where each document starts and ends."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.ends = data, starts, ends

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and the first word of each document (one more entry
        than documents). Words do not cross documents."""
        inside = table[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = self.ends > self.starts
        at = self.starts[full]
        first[at] = inside[at]
        at = self.ends[full] - 1
        last[at] = inside[at]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.append(np.searchsorted(starts, self.starts), len(starts))


@cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x2545F4914F6CDD1D
    up = np.full(length, base, np.uint64)
    down = np.full(length, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, the same wherever the span stands."""
    up, down = _powers(1 << max(16, int(len(values)).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string or binary column without copying it; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return Texts(held[at[0] : at[-1]], at[:-1] - at[0], at[1:] - at[0])


def slices(column: pa.Array | pa.ChunkedArray, limit: int = 1 << 21):
    """(first row, row behind the last) of pieces with about `limit` bytes; one document at least."""
    whole = texts_of(column)
    row = 0
    while row < len(whole):
        stop = int(np.searchsorted(whole.ends, whole.starts[row] + limit, "right"))
        stop = min(max(stop, row + 1), len(whole))
        yield row, stop
        row = stop


def int64s(column: pa.Array | pa.ChunkedArray, null: int) -> np.ndarray:
    return column.fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64) if isinstance(
        column, pa.Array
    ) else column.fill_null(null).to_numpy().astype(np.int64)
