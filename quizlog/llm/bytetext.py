"""Whole-batch text scanning on Arrow string columns.

A batch of texts is one byte buffer plus offsets; words, hashes and counts
are computed for all texts of a slice at once with numpy, so the per-row
Python cost disappears.  Slices are cut by bytes, which bounds the working
memory of a task whatever the number of rows in an Arrow batch; one text
longer than a slice is a slice of its own.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
U64 = np.uint64


def _table(separator_ranges: list[tuple[int, int]]) -> np.ndarray:
    """Byte map: A-Z to lower case, separators to a space."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    for lo, hi in separator_ranges:
        t[lo : hi + 1] = np.where((t[lo : hi + 1] >= 97) & (t[lo : hi + 1] <= 122), t[lo : hi + 1], 32)
    return t


#: Words are runs of anything but white space 0x20, 0x09-0x0D.
SPACE_WORDS = _table([(0x20, 0x20), (0x09, 0x0D)])
#: Words are runs of ASCII letters, digits and non-ASCII characters.
ALNUM_WORDS = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: The same words as SPACE_WORDS, letters left as they are.
RAW_WORDS = np.arange(256, dtype=np.uint8)
RAW_WORDS[0x09:0x0E] = 32


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count or pa.types.is_null(texts.type):
        texts = pc.fill_null(texts.cast(pa.string()), "")  # no binary column has nulls here
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off_buf, data_buf = texts.buffers()
    if len(texts) == 0 or off_buf is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(off_buf, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], (off - off[0]).astype(np.int64)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` holding about ``max_bytes`` of text."""
    _, off = buffers(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Words:
    """Words of a slice of texts, in text order."""

    data: np.ndarray  # mapped bytes of all texts
    offsets: np.ndarray  # where each text starts, and the end
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    first: np.ndarray  # index of each text's first word, and the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def scan(texts: pa.Array, table: np.ndarray = SPACE_WORDS) -> Words:
    raw, off = buffers(texts)
    data = table[raw]
    n = data.size
    solid = data != 32
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = solid[:-1]
    before &= ~edge[:n]
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    after &= ~edge[1:]
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    return Words(data, off, start, end, np.searchsorted(start, off))


_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or _POWERS[0].size < n:
        size = max(n, SLICE_BYTES + 1)
        up = np.full(size, U64(_P), U64)
        down = np.full(size, U64(_PINV), U64)
        up[0] = down[0] = 1
        got = [np.cumprod(up), np.cumprod(down)]
        if size > 2 * SLICE_BYTES:  # a single very long text: not kept
            return got[0], got[1]
        _POWERS[:] = got
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (bijective)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of data[start:end] for many ranges at once;
    equal byte strings have equal hashes wherever they stand."""
    up, down = _powers(data.size + 1)
    sums = np.zeros(data.size + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: data.size], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_hashes(w: Words) -> np.ndarray:
    return range_hashes(w.data, w.start, w.end)


def collapsed(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with exactly one space after each: (bytes, start, end)."""
    lens = w.end - w.start
    end = np.cumsum(lens + 1) - 1
    start = end - lens
    out = np.full(int(end[-1]) + 1 if end.size else 0, 32, np.uint8)
    chars = w.data[w.data != 32]
    out[np.arange(chars.size) + np.repeat(np.arange(lens.size), lens)] = chars
    return out, start, end


def per_text(values: np.ndarray, first: np.ndarray, dtype=np.int64) -> np.ndarray:
    """Sum of values[first[i]:first[i+1]] for each text i."""
    sums = np.zeros(values.size + 1, dtype)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


_X1, _X2, _X3 = U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)
_X4, _X5 = U64(0x85EBCA77C2B2AE63), U64(0x27D4EB2F165667C5)
_LONG = 2048


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * _X2, 31) * _X1


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many ranges of ``data`` at once (unsigned); ranges beyond a
    few kilobytes go to the xxhash library one by one."""
    buf = np.concatenate([data, np.zeros(8, np.uint8)])
    v8 = np.ndarray((buf.size - 7,), "<u8", buf, strides=(1,))
    v4 = np.ndarray((buf.size - 3,), "<u4", buf, strides=(1,))
    n, s = start.size, U64(seed)
    pos = start.astype(np.int64).copy()
    left = length.astype(np.int64).copy()
    acc = np.full(n, s + _X5, U64)
    huge = np.flatnonzero(left > _LONG)
    left[huge] = 0
    with np.errstate(over="ignore"):
        wide = np.flatnonzero(left >= 32)
        if wide.size:
            lanes = [np.full(wide.size, x, U64) for x in (s + _X1 + _X2, s + _X2, s, s - _X1)]
            stripes = left[wide] // 32
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                p = pos[wide[on]] + 32 * k
                for j in range(4):
                    lanes[j][on] = _round(lanes[j][on], v8[p + 8 * j])
            h = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
            for x in lanes:
                h = (h ^ _round(U64(0), x)) * _X1 + _X4
            acc[wide] = h
            pos[wide] += 32 * stripes
            left[wide] -= 32 * stripes
        acc += length.astype(U64)
        for _ in range(3):
            on = np.flatnonzero(left >= 8)
            if not on.size:
                break
            acc[on] = _rotl(acc[on] ^ _round(U64(0), v8[pos[on]]), 27) * _X1 + _X4
            pos[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        acc[on] = _rotl(acc[on] ^ (v4[pos[on]].astype(U64) * _X1), 23) * _X2 + _X3
        pos[on] += 4
        left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero(left > 0)
            if not on.size:
                break
            acc[on] = _rotl(acc[on] ^ (buf[pos[on]].astype(U64) * _X5), 11) * _X1
            pos[on] += 1
            left[on] -= 1
        acc ^= acc >> U64(33)
        acc *= _X2
        acc ^= acc >> U64(29)
        acc *= _X3
        acc ^= acc >> U64(32)
    for i in huge:
        acc[i] = xxhash.xxh64_intdigest(buf[start[i] : start[i] + length[i]].tobytes(), seed)
    return acc
