"""SuperMinHash signatures of shingle sets.

Every element walks a random permutation of the signature's places. At its step ``j`` it offers the value
``j + r`` (``r`` random in [0, 1)) to the place it visits, and each place keeps the least offer. Places of one
element thus get ranks that differ, which lowers the variance against independent permutations. Once every
place of a set holds a value below ``j + 1``, later steps cannot change it and the walk ends.
"""

from __future__ import annotations

import numpy as np

from emberlake.llm.common import mixed

PIECE = 1 << 17  # elements walked at a time; their permutations take PIECE * places bytes
EMPTY = np.uint64(2**64 - 1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(elements: np.ndarray, owners: np.ndarray, n_sets: int, places: int) -> np.ndarray:
    """(n_sets, places) of uint64: step in the upper 16 bits, 48 random bits below; EMPTY for an empty set.

    ``elements`` are 64-bit hashes, repeats allowed; ``owners`` names the set of each. The sets of a piece
    walk together, step by step, and a set whose places are all settled leaves.
    """
    assert 0 < places <= 256
    flat = np.full(n_sets * places, EMPTY, np.uint64)
    table = flat.reshape(n_sets, places)
    identity = np.arange(places, dtype=np.uint8)
    for start in range(0, len(elements), PIECE):
        own = owners[start : start + PIECE].astype(np.int64)
        state = elements[start : start + PIECE]
        walk: np.ndarray | None = None
        for j in range(places):
            state = state + STEP
            draw = mixed(state)
            spot = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(places - j)) >> np.uint64(32)).astype(np.int64)
            if walk is None:
                place = spot
            else:
                rows = np.arange(len(own))
                place = walk[rows, spot].astype(np.int64)
                walk[rows, spot] = walk[rows, j]
            offer = (np.uint64(j) << np.uint64(48)) | (draw >> np.uint64(16))
            np.minimum.at(flat, own * places + place, offer)
            low, high = int(own[0]), int(own[-1]) + 1
            unsettled = table[low:high].max(axis=1) >= (np.uint64(j + 1) << np.uint64(48))
            stay = unsettled[own - low]
            if not stay.any():
                break
            own, state = own[stay], state[stay]
            if walk is None:
                walk = np.tile(identity, (len(own), 1))
                walk[np.arange(len(own)), spot[stay]] = 0
            elif not stay.all():
                walk = walk[stay]
    return table


def band_keys(table: np.ndarray, rows: int) -> np.ndarray:
    """(n_sets, places // rows) of int64: one hash for each band of ``rows`` places, distinct between bands."""
    n_sets, places = table.shape
    bands = places // rows
    factors = mixed(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    total = mixed(np.arange(bands, dtype=np.uint64) + np.uint64(77))[None, :].repeat(n_sets, 0)
    for k in range(rows):
        total = total + mixed(table[:, k : bands * rows : rows]) * factors[k]
    return mixed(total).view(np.int64)
