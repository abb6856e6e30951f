"""Elias-Fano sequences and an n-gram trie made of them, in one memory-mapped buffer."""

from __future__ import annotations

import tempfile

import numpy as np

from tablejobs.llm.textbatch import U64

#: One step of a quantised log10 probability; code 0 is "not seen", 1 is log10 of 1.
STEP = 0.04


def quantise(log10p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10p / STEP) + 1, 1, 255).astype(np.uint8)


def probabilities(codes: np.ndarray) -> np.ndarray:
    return _VALUES[codes]


_VALUES = np.append(0.0, 10.0 ** (-STEP * np.arange(255)))


class EliasFano:
    """A non-decreasing sequence: low bits as they are, high bits in unary."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.low, packed = arrays[f"{name}.low"], arrays[f"{name}.high"]
        self.shift, self.n = (int(x) for x in arrays[f"{name}.shape"])
        bits = np.unpackbits(np.asarray(packed), bitorder="little")
        #: First place whose high part is at least h, for every h.
        zeros = np.flatnonzero(bits == 0)
        self.first = np.append(0, zeros - np.arange(len(zeros)))
        self.first = np.minimum(self.first, self.n)

    @staticmethod
    def pack(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = np.asarray(values, U64)
        n = len(values)
        top = int(values[-1]) if n else 0
        shift = max(0, (top // max(n, 1)).bit_length() - 1)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if shift <= np.dtype(t).itemsize * 8)
        high = (values >> U64(shift)).astype(np.int64) if n else np.zeros(0, np.int64)
        bits = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        mask = U64((1 << shift) - 1)
        return {f"{name}.low": (values & mask).astype(kind), f"{name}.high": np.packbits(bits, bitorder="little"),
                f"{name}.shape": np.array([shift, n], np.int64)}

    def values(self) -> np.ndarray:
        high = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))[:self.n]
        return high.astype(U64) << U64(self.shift) | np.asarray(self.low).astype(U64)

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value not below each wanted one, whether it is equal): the
        high part gives a short range, which is halved by its low parts."""
        wanted = np.asarray(wanted, U64)
        high = wanted >> U64(self.shift)
        beyond = high >= U64(len(self.first) - 1)
        h = np.where(beyond, U64(0), high).astype(np.int64)
        lo = np.where(beyond, self.n, self.first[h])
        hi = np.where(beyond, self.n, self.first[np.minimum(h + 1, len(self.first) - 1)])
        end = hi.copy()
        low = wanted & U64((1 << self.shift) - 1)
        while True:
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            mid = (lo[live] + hi[live]) >> 1
            less = self.low[mid].astype(U64) < low[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
        found = np.zeros(len(wanted), bool)
        inside = np.flatnonzero(lo < end)
        found[inside] = self.low[lo[inside]].astype(U64) == low[inside]
        return lo, found


class Trie:
    """Contexts, monotone pointers to their successors, and the successors' quantised
    probabilities. Successors are numbered relative to their context: the sequence holds
    (place of the context, word), which increases through all contexts."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.contexts = EliasFano(arrays, "contexts")
        self.pointers = EliasFano(arrays, "pointers").values().astype(np.int64)
        self.successors = EliasFano(arrays, "successors")
        self.totals, self.codes = arrays["totals"], arrays["codes"]

    @staticmethod
    def pack(context: np.ndarray, word: np.ndarray, count: np.ndarray, discount: float) -> dict[str, np.ndarray]:
        """Levels from counted pairs: 64-bit contexts and 32-bit words, in any order; pairs may repeat."""
        contexts, place = np.unique(context, return_inverse=True)
        key = place.astype(U64) << U64(32) | word.astype(U64)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order].astype(np.int64)
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        key = key[head]
        count = np.add.reduceat(count, head) if len(head) else count
        place = (key >> U64(32)).astype(np.int64)
        totals = np.bincount(place, count, len(contexts)).astype(np.int64)
        pointers = np.append(0, np.cumsum(np.bincount(place, minlength=len(contexts))))
        codes = quantise(np.log10((count - discount) / totals[place]))
        return {**EliasFano.pack(contexts, "contexts"), **EliasFano.pack(pointers, "pointers"),
                **EliasFano.pack(key, "successors"), "totals": totals, "codes": codes}

    def lookup(self, contexts: np.ndarray, runs: np.ndarray, words: np.ndarray):
        """(count of each context, its number of successors, code of each pair); ``runs``:
        how many of ``words`` belong to each context."""
        place, known = self.contexts.successor(contexts)
        at = np.where(known, place, 0)
        if not len(self.totals):
            return np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64), np.zeros(len(words), np.uint8)
        total = np.where(known, self.totals[at], 0)
        many = np.where(known, self.pointers[at + 1] - self.pointers[at], 0)
        of = np.repeat(np.arange(len(contexts)), runs)
        pair, found = self.successors.successor(at[of].astype(U64) << U64(32) | words.astype(U64))
        found &= known[of]
        codes = np.where(found, self.codes[np.minimum(pair, len(self.codes) - 1)], 0).astype(np.uint8)
        return total, many, codes


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """One buffer: a line that describes the arrays, then their bytes."""
    head = ";".join(f"{k},{v.dtype.str},{len(v)}" for k, v in arrays.items()).encode() + b"\n"
    return head + b"".join(np.ascontiguousarray(v).tobytes() for v in arrays.values())


class Mapped:
    """The trie of a packed buffer, memory-mapped from a file that goes when this closes."""

    def __init__(self, packed: bytes):
        self.file = tempfile.NamedTemporaryFile(suffix=".trie")
        self.file.write(packed)
        self.file.flush()
        buffer = np.memmap(self.file.name, np.uint8, "r")
        head = packed.index(b"\n")
        at, arrays = head + 1, {}
        for item in packed[:head].decode().split(";"):
            name, kind, n = item.split(",")
            size = np.dtype(kind).itemsize * int(n)
            arrays[name] = np.frombuffer(buffer, np.uint8, size, at).view(kind) if size else np.zeros(0, kind)
            at += size
        self.trie = Trie(arrays)

    def __enter__(self) -> Trie:
        return self.trie

    def __exit__(self, *_) -> None:
        self.file.close()
