"""Words and hashes of text columns, many rows at a time inside a task.

Everything works on the UTF-8 bytes of an Arrow column with numpy. Rows are taken in slices of about ``SLICE_BYTES``
(one row at least), so that memory follows the slice or the longest text, never the partition.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = U64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
# bytes of words [^\x20\x09-\x0D]+
BLACK = np.ones(256, dtype=bool)
BLACK[9:14] = BLACK[32] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of slices of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a slice, and where the words of each row begin (one longer than the rows).

    Words are maximal runs of bytes of ``kind`` after lower-casing A-Z, and end with their row.
    """
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, U64), np.zeros(rows + 1, np.int64)
    low = LOWER[data]
    inside = kind[low]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    ends = np.flatnonzero(ends) + 1
    power = np.empty(len(data) + 1, U64)
    power[0] = 1
    power[1:] = _BASE
    np.multiply.accumulate(power, out=power)
    back = np.empty(len(data) + 1, U64)
    back[0] = 1
    back[1:] = _BASE_INVERSE
    np.multiply.accumulate(back, out=back)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((low.astype(U64) + U64(1)) * power[:-1], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * back[starts])
    return hashes, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; one for every word that has k - 1 words after it."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= _STEP
        out += hashes[i : i + n]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return x.view(np.int64)
