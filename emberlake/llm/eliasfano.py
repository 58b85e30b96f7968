"""Monotone sequences in Elias-Fano form, and a two-level n-gram trie made of them.

A sequence of n sorted 64-bit numbers keeps the low bits of each in a packed array and the high bits in unary:
about two bits plus the low bits a number. All levels of a trie lie in one block of bytes that is read in
place, whether it comes from a mapped file or from an Arrow buffer.
"""

from __future__ import annotations

import numpy as np

_COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_SELECT = np.zeros((256, 8), np.uint8)  # place of the r-th set bit of a byte
for _byte in range(256):
    for _rank, _bit in enumerate(b for b in range(8) if _byte >> b & 1):
        _SELECT[_byte, _rank] = _bit
_U = np.uint64


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit; ``before`` counts the set bits ahead of each 64-bit word."""
    at = np.searchsorted(before, k, side="right") - 1
    rest = (k - before[at]).astype(np.int64)
    octets = words[at].view(np.uint8).reshape(-1, 8)
    sums = np.cumsum(_COUNT[octets], axis=1, dtype=np.int64)
    which = (sums <= rest[:, None]).sum(axis=1)
    rows = np.arange(len(k))
    ahead = np.where(which > 0, sums[rows, np.maximum(which - 1, 0)], 0)
    return at * 64 + which * 8 + _SELECT[octets[rows, which], rest - ahead]


class EliasFano:
    """``n`` ascending numbers: ``get`` by place and ``successor`` by value, both for arrays of queries."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = _COUNT[high.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        self.ones_before = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else np.zeros(0, np.int64)
        self.zeros_before = np.arange(len(ones)) * 64 - self.ones_before
        self.zeros = len(high) * 64 - int(ones.sum())
        self.flipped = ~high

    @staticmethod
    def encode(values: np.ndarray) -> list[np.ndarray]:
        """The three arrays of the form: (n, low bits), packed low bits, high bits."""
        values = values.astype(_U)
        n = len(values)
        if not n:
            return [np.array([0, 0], _U), np.zeros(0, _U), np.zeros(0, _U)]
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        places = (values >> _U(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) // 64 + 2, _U)
        np.bitwise_or.at(high, places >> 6, _U(1) << (places & 63).astype(_U))
        low = np.zeros(n * low_bits // 64 + 2, _U)
        if low_bits:
            part = values & _U((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.int64) * low_bits
            word, shift = at >> 6, (at & 63).astype(_U)
            np.bitwise_or.at(low, word, part << shift)
            spill = shift.astype(np.int64) + low_bits > 64
            np.bitwise_or.at(low, word[spill] + 1, part[spill] >> (_U(64) - shift[spill]))
        return [np.array([n, low_bits], _U), low, high]

    @classmethod
    def view(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, low, high = arrays
        return cls(int(head[0]), int(head[1]), low, high)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)
        at = i.astype(np.int64) * self.low_bits
        word, shift = at >> 6, (at & 63).astype(_U)
        value = self.low[word] >> shift
        spill = shift > 0
        value[spill] |= self.low[word[spill] + 1] << (_U(64) - shift[spill])
        return value & _U((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = _select(self.high, self.ones_before, i.astype(np.int64)) - i
        return (high.astype(_U) << _U(self.low_bits)) | self._low(i)

    def _up_to(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have high bits of at most ``high``."""
        out = np.full(len(high), self.n, np.int64)
        inside = high < self.zeros
        out[inside] = _select(self.flipped, self.zeros_before, high[inside]) - high[inside]
        return out

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first number that is not below each value; ``n`` if there is none."""
        if not self.n:
            return np.zeros(len(values), np.int64)
        values = values.astype(_U)
        top = values >> _U(self.low_bits)
        high = np.minimum(top, _U(self.zeros)).astype(np.int64)
        stop = self._up_to(high)
        start = np.zeros(len(values), np.int64)
        some = high > 0
        start[some] = self._up_to(high[some] - 1)
        want = values & _U((1 << self.low_bits) - 1) if self.low_bits else np.zeros(len(values), _U)
        while (open_ := start < stop).any():
            middle = (start[open_] + stop[open_]) >> 1
            below = self._low(middle) < want[open_]
            start[open_] = np.where(below, middle + 1, start[open_])
            stop[open_] = np.where(below, stop[open_], middle)
        return start


class Trie:
    """Words, and under each the words seen next to it, with a quantised value for every pair.

    Level one holds the words and, as a monotone sequence, where the range of each begins on level two. Level
    two is one monotone sequence over all ranges: the ordinal of the word above, then ``CHILD_BITS`` of the
    neighbour's hash. A look-up finds the word, then the successor of the neighbour within the word's range.
    """

    CHILD_BITS = 40
    LEVELS = 4096  # values are kept as one of so many, evenly spaced

    def __init__(self, block: bytes | np.ndarray) -> None:
        data = np.frombuffer(block, _U)
        sizes = data[1 : 1 + int(data[0])].astype(np.int64)
        ends = 1 + int(data[0]) + np.cumsum(sizes)
        parts = [data[e - s : e] for s, e in zip(sizes, ends, strict=True)]
        self.words, self.pointers = EliasFano.view(parts[0:3]), EliasFano.view(parts[3:6])
        self.children = EliasFano.view(parts[6:9])
        self.counts = parts[9]
        self.codes = parts[10].view(np.uint16)
        self.lowest, self.step = parts[11].view(np.float64)

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, sizes: np.ndarray, children: np.ndarray, values: np.ndarray) -> bytes:
        """``words`` ascend; ``children`` (ascending under each word, ``sizes`` many) and their ``values`` follow them."""
        above = np.repeat(np.arange(len(words), dtype=_U), sizes)
        lowest = float(values.min()) if len(values) else 0.0
        step = (float(values.max()) - lowest) / (cls.LEVELS - 1) if len(values) else 0.0
        codes = np.round((values - lowest) / (step or 1.0)).astype(np.uint16)
        codes = np.concatenate([codes, np.zeros(-len(codes) % 4, np.uint16)]).view(_U)
        parts = [
            *EliasFano.encode(words),
            *EliasFano.encode(np.concatenate([[0], np.cumsum(sizes)])),
            *EliasFano.encode((above << _U(cls.CHILD_BITS)) | children.astype(_U)),
            counts.astype(_U),
            codes,
            np.array([lowest, step]).view(_U),
        ]
        head = np.array([len(parts), *map(len, parts)], _U)
        return np.concatenate([head, *parts]).tobytes()

    def find(self, words: np.ndarray) -> np.ndarray:
        """Ordinal of each word, -1 if it isn't there."""
        if not self.words.n:
            return np.full(len(words), -1, np.int64)
        at = self.words.successor(words)
        inside = at < self.words.n
        hit = inside.copy()
        hit[inside] = self.words.get(at[inside]) == words[inside]
        return np.where(hit, at, -1)

    def value(self, ordinals: np.ndarray, children: np.ndarray) -> np.ndarray:
        """Value of each pair, NaN where it isn't there."""
        out = np.full(len(ordinals), np.nan)
        rows = np.flatnonzero(ordinals >= 0)
        if not self.children.n or not len(rows):
            return out
        own = ordinals[rows]
        keys = (own.astype(_U) << _U(self.CHILD_BITS)) | children[rows].astype(_U)
        at = self.children.successor(keys)
        inside = (at >= self.pointers.get(own).astype(np.int64)) & (at < self.pointers.get(own + 1).astype(np.int64))
        rows, at, keys = rows[inside], at[inside], keys[inside]
        hit = self.children.get(at) == keys
        out[rows[hit]] = self.lowest + self.step * self.codes[at[hit]]
        return out
