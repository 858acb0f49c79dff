"""Word tables of whole texts, a few megabytes at a time.

Words are found and hashed over the bytes of many texts at once.  A text is
never cut: one that is larger than a slice makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_BYTES = np.arange(256)
IN_WHITE_WORD = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
IN_ALNUM_WORD = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
IS_CONTINUATION = (_BYTES & 0xC0) == 0x80

_rng = np.random.default_rng(20_26)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit codes (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows so that the texts of each make about ``size`` bytes."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, NULL as empty, and the offsets between them."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """Words of a slice in order: byte ``start`` and ``end``, row ``doc``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool = False):
        if lower:
            data = LOWER[data]
        self.data, self.offsets = data, offsets
        within = inside[data]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins, stops = within.copy(), within.copy()
        if len(data):
            begins[1:] &= ~within[:-1]
            stops[:-1] &= ~within[1:]
            begins[edges] = within[edges]
            stops[edges - 1] = within[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self._within = within
        #: Words before each row, so row k has words first[k] to first[k + 1].
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit code of each word's bytes, the same in every slice."""
        if not len(self):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        gaps = np.diff(np.append(self.start, len(self.data)))
        lead = self.start[0]
        place = np.arange(lead, len(self.data)) - np.repeat(self.start, gaps)
        place = np.minimum(place, length.max() - 1)
        code = _BYTE_CODE[self.data[lead:]]
        code *= powers(int(length.max()))[place]
        code *= self._within[lead:]
        return mix(np.add.reduceat(code, self.start - lead) + length.astype(np.uint64) * _BASE)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def windows(codes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of each run of ``width`` consecutive words within a row, and its first word."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    weight = powers(width + 1)
    code = np.zeros(n, np.uint64)
    for k in range(width):
        code += codes[k : k + n] * weight[k + 1]
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    at = np.flatnonzero(left >= width)
    return mix(code[at]), at


def counted(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each row's run of entries."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def pack_varints(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low bits first; byte offsets of the groups ``first`` delimits."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 10):
        size += values >= np.uint64(1) << np.uint64(7 * k)
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(at[-1], np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        has = size > k
        part = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[:-1][has] + k] = part + (size[has] > k + 1) * np.uint64(128)
    return out, at[first]


def unpack_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 128)
    begin = np.concatenate(([0], last[:-1] + 1))
    out = (raw[begin] & 127).astype(np.int64)
    longer = np.flatnonzero(last > begin)
    k = 1
    while len(longer):
        at = begin[longer] + k
        out[longer] |= (raw[at] & 127).astype(np.int64) << (7 * k)
        longer = longer[last[longer] > at]
        k += 1
    return out


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    offsets = np.ascontiguousarray(offsets, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
