"""Hashed n-grams of many byte strings at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes handled together; a longer text is cut here, its n-grams across the cut included.
PIECE = 1 << 19


def gram_ids(codes: np.ndarray, n: int, dims: int, radix: int = 257) -> np.ndarray:
    """Bucket of each run of ``n`` codes."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    h = np.full(size, n, np.uint64)
    for i in range(n):
        h = h * np.uint64(radix) + codes[i : i + size]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)).astype(np.int64) % dims


def pieces(data: bytes, table: np.ndarray | None, longest: int) -> Iterator[tuple[np.ndarray, int]]:
    """(codes, n-grams to skip at the front) of consecutive stretches that overlap by ``longest`` - 1."""
    for at in range(0, len(data), PIECE):
        lead = min(at, longest - 1)
        codes = np.frombuffer(data, np.uint8, min(PIECE, len(data) - at) + lead, at - lead)
        yield (table[codes] if table is not None else codes.astype(np.uint64)), lead


def grams(data: bytes, sizes: tuple[int, ...], dims: int, table: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of ``data``, every one once, in bounded arrays."""
    for codes, lead in pieces(data, table, max(sizes)):
        for n in sizes:
            yield gram_ids(codes[max(0, lead - n + 1) :] if lead else codes, n, dims)
