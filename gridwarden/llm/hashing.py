"""Hashes of words and word shingles for whole batches of texts, in numpy.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A word's hash is a polynomial of its bytes
modulo 2^64, taken for all words of a batch from one running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Keeps the tables that every chunk needs."""

    def __init__(self, size: int = CHUNK_BYTES + (1 << 16)):
        byte = np.arange(256)
        digit, upper, lower = (byte >= 48) & (byte <= 57), (byte >= 65) & (byte <= 90), (byte >= 97) & (byte <= 122)
        self.is_word = digit | upper | lower | (byte >= 128)
        self.value = mixed((np.where(upper, byte + 32, byte) + 1).astype(np.uint64))
        self.grow(size)

    def grow(self, size: int) -> None:
        self.up, self.down = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)

    def chunk(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Begins and hashes of the words of a chunk."""
        raw = np.frombuffer(data, np.uint8)
        if len(raw) > len(self.up):
            self.grow(len(raw))
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = self.is_word[raw]
        edge = np.diff(inside)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        running = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[raw] * self.up[: len(raw)], out=running[1:])
        return begin, mixed((running[end] - running[begin]) * self.down[begin])

    def long_text(self, data: bytes) -> np.ndarray:
        """Word hashes of a text of any length, cut between words."""
        parts, at = [], 0
        while at < len(data):
            end = min(at + CHUNK_BYTES, len(data))
            while end < len(data) and self.is_word[data[end]]:
                end += 1
            parts.append(self.chunk(data[at:end])[1])
            at = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The word hashes of each text in order; null texts have none."""
        held, size = [], 0
        for text in texts:
            data = (text or "").encode()
            if size + len(data) > CHUNK_BYTES and held:
                yield from self.several(held)
                held, size = [], 0
            if len(data) > CHUNK_BYTES:
                yield self.long_text(data)
            else:
                held.append(data)
                size += len(data) + 1
        yield from self.several(held)

    def several(self, held: list[bytes]) -> Iterator[np.ndarray]:
        begin, hashes = self.chunk(b" ".join(held))
        cuts = np.cumsum([len(data) + 1 for data in held])
        at = 0
        for cut in np.searchsorted(begin, cuts).tolist():
            yield hashes[at:cut]
            at = cut


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """The sorted set of hashes of n words in a row; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total = (total + words[k : len(words) - n + 1 + k]) * np.uint64(BASE)
    return np.unique(mixed(total))
