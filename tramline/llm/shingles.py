"""Word and shingle hashing on whole texts, vectorised over a batch of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
CHUNK_BYTES = 1 << 20

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        m = max(n, CHUNK_BYTES + 4096)
        for k, b in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(m, b, U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit over all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the bounds of each text's words in that array (len(texts) + 1)."""
    data = b" ".join(texts).translate(LOWER)
    buf = np.frombuffer(data, np.uint8)
    if not len(buf):
        return np.zeros(0, U), np.zeros(len(texts) + 1, np.int64)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~IS_BLANK[buf]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(buf))
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum(BYTE_CODES[buf] * up, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U)) if len(starts) else np.zeros(0, U)
    stops = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.concatenate([[0], np.searchsorted(starts, stops)])


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles; of the whole sequence if it has fewer words."""
    odd = [U((BASE * (2 * j + 3)) % (1 << 64) | 1) for j in range(k)]
    hashes, bounds = word_hashes(texts)
    n = len(hashes)
    rolled = np.zeros(max(0, n - k + 1), U)
    for j in range(k):
        rolled += mix(hashes[j : n - k + 1 + j] * odd[j]) if n >= k else U(0)
    rolled = mix(rolled)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            own = sum(int(mix(hashes[a + j : a + j + 1] * odd[j])[0]) for j in range(b - a))
            yield mix(np.array([(own + int(b - a)) % (1 << 64)], U))
        else:
            yield np.zeros(0, U)


def chunks(texts: list[bytes | None], most: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Runs of texts of about ``most`` bytes, so that working arrays stay small; null is empty, and a longer text is a run of its own."""
    held, size = [], 0
    for t in texts:
        t = t or b""
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held
