"""Vectorised helpers over Arrow batches of UTF-8 text.

Everything here works on one bounded slice of one task's rows: a NumPy view of
the bytes of consecutive texts plus their offsets. Null texts are empty.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Rows handled at once, so that a row number fits in 12 bits.
SLICE_ROWS = 4096

U64 = np.uint64


def trim_memory() -> None:
    """Give the allocators' unused pages back to the system after a large task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc
    if trim is not None:
        trim(0)


#: What this Python worker keeps from task to task, by what it is for.
_KEPT: dict = {}


def kept(key, make: Callable):
    """``make()``, kept for the worker's next tasks with the same key. Workers outlive a
    stage: what they kept for another one goes first, or the stages' caches would add up."""
    if key not in _KEPT:
        _KEPT.clear()
        gc.collect()
        trim_memory()
        _KEPT[key] = make()
    return _KEPT[key]


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array, without a copy. ``offsets``
    has one entry more than there are rows and starts at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if large else np.int32)
    offsets = offsets[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if column.null_count:
        gone = np.asarray(column.is_null())
        if (np.diff(offsets)[gone] > 0).any():      # bytes behind a null: squeeze them out
            column = column.fill_null("" if "string" in str(column.type) else b"")
            return text_view(pa.concat_arrays([column]))
    return raw, offsets


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of whole rows holding up to ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_view(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), lo + SLICE_ROWS, batch.num_rows)
            yield (batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]],
                   offsets[lo:hi + 1] - offsets[lo])
            lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), over a whole array."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


class WordHasher:
    """Words of a slice and a 64-bit hash of each.

    ``is_word`` marks the bytes words are made of; ``A-Z`` hash as ``a-z`` when
    ``fold`` is set. The hash is a polynomial over random byte values, taken as
    a difference of prefix sums, so its cost does not depend on word lengths.
    Modulo 2 ** 64 such polynomials agree on some pairs of long patterned words
    whatever the base, so words above ``LONG`` bytes, of which there are few, are
    hashed one by one (BLAKE2); below that the pattern is too short to cancel.
    Words with equal hashes are taken for equal: 64 bits, by chance only.
    """

    BASE = U64(0x2545F4914F6CDD1D)
    LONG = 64

    def __init__(self, is_word: np.ndarray, fold: bool = True):
        self.is_word = is_word
        self.values = _byte_values(7)
        self.folded = bytes(range(256))
        if fold:
            self.values[65:91] = self.values[97:123]
            self.folded = self.folded.lower()
        self._powers = np.ones(1, U64)

    def powers(self, n: int) -> np.ndarray:
        if len(self._powers) < n:
            size = max(n, SLICE_BYTES + 2)
            p = np.full(size, self.BASE, U64)
            p[0] = 1
            self._powers = np.multiply.accumulate(p)
        return self._powers

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends, row of each word)."""
        n = len(data)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, z
        inside = self.is_word[data]
        first = np.empty(n, bool)
        first[0] = inside[0]
        np.greater(inside[1:], inside[:-1], out=first[1:])
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        first[cuts] = inside[cuts]
        last = np.empty(n, bool)
        last[-1] = inside[-1]
        np.greater(inside[:-1], inside[1:], out=last[:-1])
        last[cuts - 1] = inside[cuts - 1]
        starts = np.flatnonzero(first)
        ends = np.flatnonzero(last) + 1
        row = np.searchsorted(offsets, starts, side="right") - 1
        return starts, ends, row

    def _sums(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.values[data] * self.powers(len(data) + 1)[:len(data)], out=sums[1:])
        return sums

    def _polynomials(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(sums) - 1
        power = self.powers(n + 1)
        h = (sums[ends] - sums[starts]) * power[n - starts]
        # the shift by n - start leaves a factor that depends on n only
        return mix(h * inverse(power[n]))

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, U64)
        h = self._polynomials(self._sums(data), starts, ends)
        for k in np.flatnonzero(ends - starts > self.LONG).tolist():
            word = data[starts[k]:ends[k]].tobytes().translate(self.folded)
            h[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def passages(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each of many passages above ``LONG`` bytes, as a chain of
        the polynomials of their pieces of up to ``LONG`` bytes."""
        h = mix((ends - starts).astype(U64))
        sums, most = self._sums(data), int((ends - starts).max(initial=0))
        for at in range(0, most, self.LONG):
            lo = np.minimum(starts + at, ends)
            h = mix(h * self.BASE + self._polynomials(sums, lo, np.minimum(lo + self.LONG, ends)))
        return h


def inverse(x) -> np.uint64:
    """The inverse of an odd number modulo 2**64."""
    return U64(pow(int(x), -1, 1 << 64))


def word_table(outside: bytes | range | list[int]) -> np.ndarray:
    """Marks of word bytes: all but ``outside``."""
    table = np.ones(256, bool)
    table[list(outside)] = False
    return table


#: ``[^\x20\x09-\x0D]+``
SPACED = word_table([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, letters, non-ASCII.
ALNUM = word_table([b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)])


def row_counts(row: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(row, minlength=n_rows).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + l)``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - (ends - lengths), lengths)


def binary_array(blob: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column whose i-th value is the bytes of ``blob[cuts[i]:cuts[i+1]]``."""
    width = blob.dtype.itemsize
    at = np.asarray(cuts, np.int64) * width
    if at[-1] >= 2**31:
        raise ValueError("more than 2 GB in one batch")
    return pa.Array.from_buffers(
        pa.binary(), len(at) - 1,
        [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(blob))])


if sys.byteorder != "little":      # packed columns are little-endian
    raise ImportError("a little-endian machine is needed")
