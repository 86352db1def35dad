"""Elias-Fano sequences and a two-level n-gram trie, in memory-mapped files, queried in batches."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

ONE = np.uint64(1)
WORD = np.uint64(64)
#: Codes of weights that are not 0, which fill 12 bits.
LEVELS = 4095


def _packed_bits(bits: np.ndarray) -> np.ndarray:
    """Bits (uint8, first lowest) as 64-bit words, one more than needed."""
    filled = np.zeros((len(bits) // 64 + 2) * 64, np.uint8)
    filled[: len(bits)] = bits
    return np.packbits(filled, bitorder="little").view("<u8")


class MappedArrays:
    """Arrays in one file that is mapped read-only; the file is gone when they are."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self._file = tempfile.TemporaryFile()
        places, at = {}, 0
        for name, array in arrays.items():
            raw = np.ascontiguousarray(array)
            self._file.write(raw.tobytes())
            places[name] = (raw.dtype, len(raw), at)
            pad = -raw.nbytes % 8
            self._file.write(b"\0" * pad)
            at += raw.nbytes + pad
        self._file.flush()
        self.n_bytes = at
        self._map = mmap.mmap(self._file.fileno(), at, access=mmap.ACCESS_READ) if at else b""
        self.arrays = {k: np.frombuffer(self._map, d, n, a) for k, (d, n, a) in places.items()}

    def __getitem__(self, name: str) -> np.ndarray:
        return self.arrays[name]


def encoded(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """A non-decreasing sequence: lower bits side by side, upper bits in unary."""
    values = values.astype(np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    shift = np.uint64(low)
    lower = np.empty(n * low, np.uint8)
    for bit in range(low):
        lower[bit::low] = ((values >> np.uint64(bit)) & ONE).astype(np.uint8)
    upper = np.zeros(n + (top >> low) + 2, np.uint8)
    upper[(values >> shift).astype(np.int64) + np.arange(n)] = 1
    words = _packed_bits(upper)
    ones = np.bitwise_count(words).astype(np.int64)
    return {
        f"{name}.head": np.array([n, low, top], "<u8"), f"{name}.lower": _packed_bits(lower), f"{name}.upper": words,
        f"{name}.ones": np.append(0, np.cumsum(ones)), f"{name}.zeros": np.append(0, np.cumsum(64 - ones)),
    }


def _select(words: np.ndarray, before: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the set bit with the given number, from 0, in ``words``."""
    at = np.searchsorted(before, rank, "right") - 1
    word, left = words[at], (rank - before[at]).astype(np.uint64)
    place = np.zeros(len(rank), np.uint64)
    for size in (32, 16, 8, 4, 2, 1):
        half = (word >> place) & np.uint64((1 << size) - 1)
        count = np.bitwise_count(half).astype(np.uint64)
        beyond = left >= count
        left -= np.where(beyond, count, np.uint64(0))
        place += np.where(beyond, np.uint64(size), np.uint64(0))
    return at * 64 + place.astype(np.int64)


class Sequence:
    """Access and successor search in an encoded sequence, for many queries at once."""

    def __init__(self, arrays, name: str):
        self.n, self.low, self.top = (int(x) for x in arrays[f"{name}.head"])
        self.lower, self.upper = arrays[f"{name}.lower"], arrays[f"{name}.upper"]
        self.ones, self.zeros = arrays[f"{name}.ones"], arrays[f"{name}.zeros"]
        self.unset = ~self.upper

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        bit = i.astype(np.uint64) * np.uint64(self.low)
        at, off = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        high = np.where(off > 0, self.lower[at + 1] << ((WORD - off) & np.uint64(63)), np.uint64(0))
        return ((self.lower[at] >> off) | high) & np.uint64((1 << self.low) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        high = (_select(self.upper, self.ones, i) - i).astype(np.uint64)
        return (high << np.uint64(self.low)) | self.low_bits(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each value; -1 if it is not there. Its upper bits name a few candidates."""
        x = x.astype(np.uint64)
        inside = x <= np.uint64(self.top)
        high = np.where(inside, x >> np.uint64(self.low), np.uint64(0)).astype(np.int64)
        want = x & np.uint64((1 << self.low) - 1)
        begin = np.zeros(len(x), np.int64)
        later = high > 0
        begin[later] = _select(self.unset, self.zeros, high[later] - 1) + 1 - high[later]
        end = _select(self.unset, self.zeros, high) - high
        while True:  # binary search for the first lower part that is not smaller
            open_ = np.flatnonzero(begin < end)
            if not len(open_):
                break
            middle = (begin[open_] + end[open_]) // 2
            smaller = self.low_bits(middle) < want[open_]
            begin[open_] = np.where(smaller, middle + 1, begin[open_])
            end[open_] = np.where(smaller, end[open_], middle)
        at = np.minimum(begin, max(self.n - 1, 0))
        if not self.n:
            return np.full(len(x), -1)
        hit = inside & (begin < self.n)
        hit[hit] = self.access(at[hit]) == x[hit]
        return np.where(hit, at, -1)


def code_book(lowest: float, levels: int = LEVELS) -> np.ndarray:
    """Value of each code: codes from 1 are bins even in logarithm from ``lowest`` to 1, code 0 stands for 0."""
    middle = (np.arange(levels) + 0.5) / levels
    return np.append(0.0, np.exp(np.log(lowest) * (1 - middle)))


def quantised(values: np.ndarray, lowest: float, levels: int = LEVELS) -> np.ndarray:
    """Codes from 1 of values between ``lowest`` and 1; the same value has the same code everywhere."""
    place = 1 - np.log(values) / np.log(lowest)
    return (np.clip((place * levels).astype(np.int64), 0, levels - 1) + 1).astype(np.uint16)


class BigramTrie:
    """Contexts, monotone pointers to their successors, and the successors' quantised weights.

    The successors of a context are its words in ascending order, each moved behind the last
    successor of the context before, which makes the whole level one ascending sequence.
    """

    def __init__(self, contexts: np.ndarray, pointers: np.ndarray, words: np.ndarray,
                 weights: np.ndarray, lowest: float):
        """``contexts`` ascending, ``pointers`` one longer, ``words`` ascending in each range.

        ``lowest`` is the least weight that any trie of the model can hold.
        """
        sizes = np.diff(pointers)
        last = words[pointers[1:] - 1] + 1 if len(contexts) else np.empty(0, np.int64)
        bases = np.cumsum(last) - last
        level = words + 1 + np.repeat(bases, sizes)
        codes = quantised(weights, lowest)
        self.arrays = MappedArrays(
            encoded(contexts, "contexts") | encoded(pointers, "pointers") | encoded(level, "level") | {"codes": codes}
        )
        self.contexts, self.pointers, self.level = (Sequence(self.arrays, k) for k in ("contexts", "pointers", "level"))

    def codes(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Code of every pair; 0 if the pair is not in the trie."""
        out = np.zeros(len(contexts), np.uint16)
        rank = self.contexts.find(contexts)
        at = np.flatnonzero(rank >= 0)
        if not len(at):
            return out
        known, inverse = np.unique(rank[at], return_inverse=True)
        begin, end = self.pointers.access(known).astype(np.int64), self.pointers.access(known + 1).astype(np.int64)
        base = np.zeros(len(known), np.uint64)
        base[begin > 0] = self.level.access(begin[begin > 0] - 1)
        own = self.level.find(base[inverse] + (words[at] + 1).astype(np.uint64))
        hit = (own >= begin[inverse]) & (own < end[inverse])
        out[at[hit]] = self.arrays["codes"][own[hit]]
        return out
