"""Whole columns of text as byte buffers: words, word hashes and window hashes without a Python loop per word.

Everything here works inside one Arrow batch. Words are found on UTF-8 bytes, which is exact because every separator
is ASCII. Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # of text worked on at once; one longer text is a slice of its own
LONG_WORD = 1 << 12  # bytes from which a word is hashed on its own
HASH_BYTES = 1 << 18  # of words hashed at once

_MULT = 0x9E3779B97F4A7C15
_WINDOW_MULT = 0xD1342543DE82EF95
_WRAP = (1 << 64) - 1

#: Separators of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` on text whose A-Z are lower-cased.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BYTE_VALUES = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") | 1 for b in range(256)], np.uint64
)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse_base = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(self.base, n), _powers(self.inverse_base, n)
        return self.up, self.down


_BYTE_POWERS, _WORD_POWERS = _Powers(_MULT), _Powers(_WINDOW_MULT)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: byte ranges in ``data``; text d has the words bounds[d]:bounds[d + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def joined(self, index: np.ndarray) -> bytes:
        """The words at ``index`` (ascending), joined by one space."""
        if not len(index):
            return b""
        starts, sizes = self.starts[index], self.ends[index] - self.starts[index] + 1
        places = np.cumsum(sizes) - sizes
        out = np.arange(int(sizes.sum())) + np.repeat(starts - places, sizes)
        gaps = places + sizes - 1
        out[gaps] = 0
        taken = self.data[out]
        taken[gaps] = 0x20
        return taken[:-1].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``most`` bytes of text."""
    data, offsets = buffers(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    inside = ~separators[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes, spread by ``mixed``."""
    out = np.empty(len(w.starts), np.uint64)
    sizes = w.ends - w.starts
    long_words = np.flatnonzero(sizes > LONG_WORD)
    lo = 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(w.starts, w.starts[lo] + HASH_BYTES)))
        first, last = w.starts[lo], w.ends[hi - 1]
        if hi - lo == 1 and sizes[lo] > LONG_WORD:
            lo = hi  # below
            continue
        up, down = _BYTE_POWERS.get(int(last - first) + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[w.data[first:last]] * up[: last - first], out=sums[1:])
        at, to = w.starts[lo:hi] - first, w.ends[lo:hi] - first
        out[lo:hi] = (sums[to] - sums[at]) * down[at]
        lo = hi
    out = mixed(out + sizes.astype(np.uint64) * np.uint64(_MULT))
    for i in long_words:
        digest = hashlib.blake2b(w.data[w.starts[i] : w.ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a string column."""
    sizes = ends - starts
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    raw = data[np.arange(int(at[-1])) + np.repeat(starts - at[:-1], sizes)]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(raw))


def window_hashes(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values; texts are not kept apart."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORD_POWERS.get(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    raw = (sums[size:] - sums[:n]) * down[:n]
    return mixed(raw + np.uint64((size * _MULT + salt * _WINDOW_MULT) & _WRAP))


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Positions of the windows that lie inside one text."""
    n = int(bounds[-1])
    inside = np.zeros(max(0, n - size + 1) + 1, np.int64)
    lo, hi = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - size + 1)
    keep = hi > lo
    np.add.at(inside, lo[keep], 1)
    np.add.at(inside, hi[keep], -1)
    return np.flatnonzero(np.cumsum(inside)[:-1])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string of long, int, double, boolean, string, binary and array<long> columns."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
        "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def lists_of(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Array column from flat values and n + 1 bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind or pa.int64()))
