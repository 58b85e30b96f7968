"""Words, shingles and their hashes for many texts at once, in numpy inside a task."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from emberlake.llm.common import mixed

PIECE = 1 << 18  # bytes hashed at a time
FACTOR = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of some texts in order; text ``i`` owns positions ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    hashes: np.ndarray  # 64-bit, one per position
    begins: np.ndarray  # where each word begins in ``data``
    ends: np.ndarray
    data: np.ndarray  # the bytes of all texts
    offsets: np.ndarray  # where each text begins in ``data``

    def __len__(self) -> int:
        return len(self.starts) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each text begins (and the last ends); null is empty."""
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's factor and of its inverse modulo 2^64."""
    up = np.full(n, FACTOR, np.uint64)
    down = np.full(n, pow(FACTOR, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def hash_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each span (in order, not overlapping) of the bytes, A-Z read as a-z if ``lower``."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(FACTOR))
    if lower:
        values = values[LOWER]
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + PIECE, side="right")))
        base, stop = int(begins[i]), int(ends[j - 1])
        size = stop - base
        up, down = _powers(PIECE) if size <= PIECE else _powers(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[base:stop]] * up[:size], out=sums[1:])
        b, e = begins[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64)
        i = j
    return mixed(out)


def split_words(texts: pa.Array, bare: bool = False) -> Words:
    """Words between white space, A-Z read as a-z; null counts as no words.

    ``bare``: ASCII marks at both ends of a word don't count; a word of marks only is none.
    """
    data, offsets = text_bytes(texts)
    space = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    ink = ~space
    begins = ink.copy()
    begins[1:] &= space[:-1] | edge[1:-1]
    ends = ink
    ends[:-1] &= space[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if bare:
        plain = ALNUM[data]
        while True:
            trim = begins < ends
            trim[trim] = ~plain[begins[trim]]
            if not trim.any():
                break
            begins = begins + trim
        real = begins < ends
        begins, ends = begins[real], ends[real]
        while (trim := ~plain[ends - 1]).any():
            ends = ends - trim
    return Words(np.searchsorted(begins, offsets), hash_spans(data, begins, ends), begins, ends, data, offsets)


def weighted_sums(hashes: np.ndarray, offsets: list[int] | tuple[int, ...], seed: int) -> np.ndarray:
    """Hash at each position of the words at ``offsets`` from it; as long as positions allow."""
    factors = mixed(np.arange(1, len(offsets) + 1, dtype=np.uint64) + np.uint64(seed * 1000)) | np.uint64(1)
    n = max(0, len(hashes) - offsets[-1])
    total = np.full(n, seed, np.uint64)
    for offset, factor in zip(offsets, factors, strict=True):
        total += hashes[offset : offset + n] * factor
    return mixed(total)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and where those of each text start.

    A text with fewer words, but at least one, has its whole sequence as its one shingle.
    """
    hashes, counts = words.hashes, words.counts
    runs = weighted_sums(hashes, range(width), width)
    full = np.maximum(counts - width + 1, 0)
    sizes = np.where((counts > 0) & (full == 0), 1, full)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(words)), full)
    inside = words.starts[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    out = np.empty(starts[-1], np.uint64)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full) + starts[:-1][owner]
    out[place] = runs[inside]
    for i in np.flatnonzero((counts > 0) & (full == 0)):
        n = int(counts[i])
        begin = words.starts[i]
        out[starts[i]] = weighted_sums(hashes[begin : begin + n], range(n), n)[0]
    return out, starts
