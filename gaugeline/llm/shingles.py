"""Word shingles of whole texts as 64-bit hashes, vectorised over many texts."""

from __future__ import annotations

import numpy as np

WORDS = 5
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < size:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            table = np.full(2 * size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:size], _powers[1][:size]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are runs without ASCII white space, A-Z lowered. A text with fewer than
    ``words`` words is one shingle; one without words has none.
    """
    split = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    if not counts.sum():
        return [np.zeros(0, np.uint64)] * len(texts)
    data = np.frombuffer(b" ".join([w for s in split for w in s]), np.uint8)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], out=sums[1:])
    spaces = np.flatnonzero(data == 32)
    start = np.concatenate([[0], spaces + 1])
    end = np.concatenate([spaces, [len(data)]])
    last = np.repeat(np.cumsum(counts) - 1, counts)  # the last word of each word's text
    first = np.repeat(np.cumsum(counts) - counts, counts)
    place = np.arange(len(start))
    at = np.flatnonzero((place + words - 1 <= last) | (place == first))
    to = np.minimum(at + words - 1, last[at])
    hashes = mixed((sums[end[to]] - sums[start[at]]) * inverse[start[at]])
    owned = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    stops = np.cumsum(owned)
    return [np.unique(hashes[stop - n:stop]) for stop, n in zip(stops, owned)]
