"""Word hashes of several texts with fingerprints of any stretch of them."""

from __future__ import annotations

import numpy as np

from salesmart.llm.common import mix64

# Two odd numbers without structure; BASE has an inverse modulo 2**64.
ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD1342543DE82EF95)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(BASE), -1, 2**64))
    ones = np.ones(n + 1, np.uint64)
    up, down = ones.copy(), ones
    up[1:], down[1:] = BASE, inverse
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Block:
    """Texts of a block with fingerprints of any stretch of words."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        self.words, self.offsets = words, offsets
        self.up, self.down = _powers(len(words))
        terms = mix64(words.view(np.uint64)) * self.up[:-1]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def fingerprint(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        stretch = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix64(stretch + (end - start).astype(np.uint64) * ODD)

    def windows(self, size: int) -> np.ndarray:
        """Starts of all windows that lie in one text."""
        places = np.arange(len(self.words), dtype=np.int64)
        return places[places + size <= np.repeat(self.offsets[1:], np.diff(self.offsets))]
