"""One-permutation MinHash with optimal densification, cut into bands."""

from __future__ import annotations

import numpy as np

from tramline.llm.shingles import BASE, U, mix

BANDS, ROWS = 50, 8
BINS = BANDS * ROWS
EDGES = np.array([(i << 64) // BINS for i in range(BINS)], U)
#: For each bin, all bins in a random order: an empty bin borrows from the first filled one in its own order.
ORDER = np.argsort(np.random.default_rng(977).random((BINS, BINS)), axis=1).astype(np.int16)
SHORT = np.ascontiguousarray(ORDER[:, :12])
FACTORS = np.array([(BASE * (2 * j + 1)) % (1 << 64) | 1 for j in range(ROWS)], U)
SALTS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * U(BASE))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each bin. The shingle hash is the one permutation: its high part picks the bin, so in sorted order a bin is a range."""
    first = np.searchsorted(shingles, EDGES)
    following = np.append(first[1:], len(shingles))
    filled = first < following
    out = np.zeros(BINS, U)
    out[filled] = shingles[first[filled]]
    lack = np.flatnonzero(~filled)
    for order in (SHORT, ORDER):  # most are settled within a few steps
        if len(lack):
            reach = filled[order[lack]]
            step = reach.argmax(axis=1)
            found = reach[np.arange(len(lack)), step]
            out[lack[found]] = out[order[lack[found], step[found]]]
            lack = lack[~found]
    return out


def bands(shingles: np.ndarray) -> np.ndarray:
    """BANDS bucket keys, each of ROWS bins and of the band's place."""
    return mix((signature(shingles).reshape(BANDS, ROWS) * FACTORS).sum(axis=1, dtype=np.uint64) + SALTS)
